"""DuckDB form of the derived views, as CTE text."""

from verification.views import COUNTERS, FRACTIONS

MATCHES = """
matches AS (
  SELECT o_orderkey AS id_jogo,
         CAST(o_orderdate AS DATE) AS data,
         printf('%02d:%02d', 12 + o_custkey % 10, (o_orderkey % 4) * 15) AS hora,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Mundo' ELSE r_name END AS pais,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Amistoso'
              ELSE o_orderpriority END AS campeonato,
         CAST(1 + o_orderkey % 38 AS VARCHAR) AS rodada,
         h.n_name AS casa, a.n_name AS fora,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
              THEN CAST(cents % 97 % 6 AS INTEGER) END AS gols_casa,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
              THEN CAST(cents % 89 % 5 AS INTEGER) END AS gols_fora,
         CASE WHEN r_name = 'EUROPE'
              THEN CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) + 1 AS VARCHAR)
              ELSE CAST(year(o_orderdate) AS VARCHAR) END AS temporada,
         CASE WHEN o_custkey % 23 <> 0
              THEN CAST((90 + cents % 4999) / 100.0 AS DECIMAL(8,2)) END AS odd_casa,
         CASE WHEN o_custkey % 23 <> 0
              THEN CAST((250 + cents % 311) / 100.0 AS DECIMAL(8,2)) END AS odd_empate,
         CASE WHEN o_custkey % 23 <> 0
              THEN CAST((90 + cents % 5501) / 100.0 AS DECIMAL(8,2)) END AS odd_fora,
         cents
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) o
  JOIN customer c ON o_custkey = c_custkey
  JOIN nation h ON c_nationkey = h.n_nationkey
  JOIN region r ON h.n_regionkey = r_regionkey
  JOIN nation a ON (c_nationkey + 1 + (o_orderkey * 7 + o_custkey) % 24) % 25 = a.n_nationkey
)"""

GAMES = (
    MATCHES
    + """,
games AS (
  SELECT id_jogo, data, hora, temporada, campeonato, pais, clube, adversario, mando, gm, gs, odd,
         CASE WHEN gm > gs THEN 1 ELSE 0 END AS venceu,
         CASE WHEN gm = gs THEN 1 ELSE 0 END AS empatou,
         CASE WHEN gm < gs THEN 1 ELSE 0 END AS perdeu,
         CASE WHEN gm > gs THEN 3 WHEN gm = gs THEN 1 ELSE 0 END AS pontos,
         gm + gs AS total_gols
  FROM (
    SELECT id_jogo, data, hora, temporada, campeonato, pais, casa AS clube, fora AS adversario,
           'Casa' AS mando, gols_casa AS gm, gols_fora AS gs, odd_casa AS odd FROM matches
    UNION ALL
    SELECT id_jogo, data, hora, temporada, campeonato, pais, fora, casa, 'Fora',
           gols_fora, gols_casa, odd_fora FROM matches
  ) WHERE gm IS NOT NULL AND gs IS NOT NULL
)"""
)


def _counter(name: str) -> str:
    prime, size = COUNTERS[name]
    one, two = f"(b + 977) % {prime} % {size}", f"(b + 1954) % {prime} % {size}"
    return (
        f"CAST(CASE periodo WHEN '1ST' THEN {one} WHEN '2ND' THEN {two} "
        f"ELSE {one} + {two} END AS INTEGER) AS {name}"
    )


def _fraction(name: str) -> str:
    prime, size = FRACTIONS[name]
    won, lost = f"(k % {prime} % {size})", f"(k % {prime + 2} % {size})"
    return (
        f"CAST({won} AS VARCHAR) || '/' || CAST({won} + {lost} AS VARCHAR) || ' (' || "
        f"CAST(({won} * 100) // greatest({won} + {lost}, 1) AS VARCHAR) || '%)' AS {name}"
    )


STATS = (
    GAMES
    + """,
stat_rows AS (
  SELECT *, CASE periodo WHEN '1ST' THEN b + 977 WHEN '2ND' THEN b + 1954 ELSE b END AS k
  FROM (
    SELECT id_jogo, temporada, clube, id_jogo * 13 + cents + lado * 101 AS b
    FROM (SELECT *, casa AS clube, 0 AS lado FROM matches
          UNION ALL SELECT *, fora, 1 FROM matches)
  ), (VALUES ('1ST'), ('2ND'), ('ALL')) p(periodo)
),
team_stats AS (
  SELECT id_jogo, periodo, clube, temporada,
         CASE WHEN k % 101 = 0 THEN 'n/d'
              WHEN k % 17 = 0 THEN CAST(30 + k % 41 AS VARCHAR) || ',5%'
              ELSE CAST(30 + k % 41 AS VARCHAR) || '%' END AS ball_possession,
         CAST(35 + k % 31 AS VARCHAR) || '%' AS duels,
         CAST(40 + k % 51 AS VARCHAR) || '%' AS tackles_won,
         CASE WHEN k % 19 <> 0 THEN (k % 1009 % 350) / 100.0::DOUBLE END AS expected_goals,
         CASE WHEN periodo <> 'ALL' THEN CASE WHEN k % 71 = 0 THEN 1 ELSE 0 END END AS red_cards,
         """
    + ",\n         ".join([_fraction(n) for n in FRACTIONS] + [_counter(n) for n in COUNTERS])
    + """
  FROM stat_rows
)"""
)

PLAYERS = (
    GAMES
    + """,
player_stats AS (
  SELECT l_orderkey AS id_jogo,
         CASE WHEN l_linenumber % 2 = 1 THEN casa ELSE fora END AS team,
         l_partkey AS player_id, p_name AS name,
         CASE WHEN p_size % 10 = 0 THEN 'Goleiro' WHEN p_size % 10 <= 3 THEN 'Defensor'
              WHEN p_size % 10 <= 6 THEN 'Meio-campo' WHEN p_size % 10 <= 8 THEN 'Atacante'
              ELSE 'Verificar' END AS position,
         CAST(1 + l_partkey % 99 AS INTEGER) AS jersey_number,
         -315619200 + l_partkey % 9000 * 86400 AS birth,
         'Country ' || CAST(p_size % 7 AS VARCHAR) AS country,
         CAST(round(p_retailprice * 100) AS BIGINT) * 10 AS value,
         l_linenumber > 4 AS substitute,
         CASE WHEN j % 23 <> 0 THEN 50 + j % 50 END AS rating10,
         greatest(0, CAST(l_quantity AS INTEGER) * 2 - 6) AS minutes,
         CASE WHEN j % 31 = 0 THEN 2 WHEN j % 7 = 0 THEN 1 ELSE 0 END AS goals,
         CASE WHEN j % 5 = 0 THEN 1 ELSE 0 END AS assists,
         j % 11 % 3 AS chances, j % 13 % 5 AS key_pass,
         CASE WHEN j % 9 <> 0 THEN j % 101 END AS xg100,
         j % 4 AS fouls,
         CASE WHEN j % 29 = 0 THEN 1 ELSE 0 END AS penalties,
         CASE WHEN j % 17 = 0 THEN 1 ELSE 0 END AS error_shot,
         CASE WHEN j % 37 = 0 THEN 1 ELSE 0 END AS error_goal,
         j % 80 AS touches, j % 60 AS total_pass, (j % 60 * 3) // 4 AS accurate_pass,
         temporada, m.data, m.hora, m.campeonato, m.pais, casa, fora
  FROM (SELECT *, l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 + l_suppkey AS j
        FROM lineitem) l
  JOIN part p ON l_partkey = p_partkey
  JOIN matches m ON l_orderkey = m.id_jogo
),
pl AS (SELECT * FROM player_stats WHERE minutes > 0)"""
)

GOALS = """
goals AS (
  SELECT user_id AS id_jogo, '2024' AS temporada, 'Copa' AS campeonato, event_type AS clube_gol,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 96 AS minutos,
         ['right-foot', 'left-foot', 'head'][event_id % 3 + 1] AS forma_gol,
         CAST(event_id % 4 AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) AS placar,
         event_id AS ordem
  FROM events
)"""
