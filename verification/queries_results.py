"""Registered queries over match results, with the SQL each must equal."""

from pyspark.sql import functions as F

from pitchlake.functions import labels
from pitchlake.operators import club_games as cg
from pitchlake.operators import reports, results, streaks
from pitchlake.functions import fixed
from verification import views
from verification.oracle_views import GAMES, MATCHES
from verification.registry import half_up, pct, query, with_

SEASON_KEY = ("temporada", "clube")


def games(spark, sf):
    return cg.club_games(views.matches(spark, sf))


# --- R1 / W1 / W3 -------------------------------------------------------------
@query("r01_club_games", with_(GAMES, """
SELECT id_jogo, CAST(data AS VARCHAR) AS data, clube, adversario, mando, gm AS gols_marcados,
       gs AS gols_sofridos, CAST(odd AS DOUBLE) AS odd, venceu, empatou, perdeu, pontos
FROM games"""))
def r01(spark, sf):
    return games(spark, sf).select(
        "id_jogo", F.col("data").cast("string").alias("data"), "clube", "adversario", "mando",
        "gols_marcados", "gols_sofridos", F.col("odd").cast("double").alias("odd"),
        "venceu", "empatou", "perdeu", "pontos",
    )


@query("w01_last_10_games", with_(GAMES, """
SELECT clube, id_jogo, CAST(data AS VARCHAR) AS data FROM (
  SELECT *, row_number() OVER (PARTITION BY clube ORDER BY data DESC, hora DESC, id_jogo DESC) rn
  FROM games) WHERE rn <= 10"""))
def w01(spark, sf):
    return cg.last_n(games(spark, sf), 10).select(
        "clube", "id_jogo", F.col("data").cast("string").alias("data")
    )


@query("w03_last_10_dates", with_(GAMES, """
SELECT clube, CAST(data AS VARCHAR) AS data, CAST(count(*) AS BIGINT) AS jogos FROM (
  SELECT *, dense_rank() OVER (PARTITION BY clube ORDER BY data DESC) dr FROM games)
WHERE dr <= 10 GROUP BY ALL"""))
def w03(spark, sf):
    return (
        cg.last_dates(games(spark, sf), 10, ("clube",))
        .groupBy("clube", F.col("data").cast("string").alias("data"))
        .agg(F.count(F.lit(1)).alias("jogos"))
    )


@query("w04_clubs_with_min_games", with_(GAMES, """
SELECT temporada, clube, id_jogo FROM (
  SELECT *, count(*) OVER (PARTITION BY temporada, clube) n FROM games) WHERE n >= 40"""))
def w04(spark, sf):
    return cg.at_least(games(spark, sf), SEASON_KEY, 40).select("temporada", "clube", "id_jogo")


# --- A1 / A2 / A3 ----------------------------------------------------------------
def _card_sql(source: str, by: str) -> str:
    def side_mean(cond: str) -> str:
        h = f"FILTER (WHERE mando = 'Casa' AND odd IS NOT NULL {cond})"
        a = f"FILTER (WHERE mando = 'Fora' AND odd IS NOT NULL {cond})"
        cents = "CAST(CAST(odd * 100 AS BIGINT) AS HUGEINT)"
        sh, nh = f"sum({cents}) {h}", f"(count(*) {h})::HUGEINT"
        sa, na = f"sum({cents}) {a}", f"(count(*) {a})::HUGEINT"
        return (
            f"CASE WHEN {nh} > 0 AND {na} > 0 THEN "
            f"{half_up(f'(({sh}) * ({na}) + ({sa}) * ({nh}))', f'(2 * 100 * ({nh}) * ({na}))')} "
            f"WHEN {nh} > 0 THEN {half_up(sh, f'(100 * {nh})')} "
            f"WHEN {na} > 0 THEN {half_up(sa, f'(100 * {na})')} END"
        )
    n = "count(*)"
    w, e = "sum(venceu)", "sum(empatou)"
    return f"""
SELECT {by}, count(*) AS jogos, CAST({w} AS BIGINT) AS vitorias, CAST({e} AS BIGINT) AS empates,
  CAST(sum(perdeu) AS BIGINT) AS derrotas, CAST(sum(gm) AS BIGINT) AS gols_marcados,
  CAST(sum(gs) AS BIGINT) AS gols_sofridos,
  {pct(f'({w} * 3 + {e})', f'({n} * 3)')} AS aproveitamento,
  count(*) FILTER (WHERE total_gols >= 3) AS over_2_5,
  {pct('(count(*) FILTER (WHERE total_gols >= 3))', n)} AS prob_over_2_5,
  count(*) FILTER (WHERE total_gols < 3) AS under_2_5,
  {pct('(count(*) FILTER (WHERE total_gols < 3))', n)} AS prob_under_2_5,
  {side_mean('')} AS odd_media, {side_mean('AND venceu = 1')} AS odd_media_vitoria,
  count(*) FILTER (WHERE gm >= 4) AS goleadas,
  {pct('(count(*) FILTER (WHERE gm >= 4))', n)} AS prob_golear,
  count(*) FILTER (WHERE gm >= 4 AND mando = 'Casa') AS goleadas_mandante,
  count(*) FILTER (WHERE gm >= 4 AND mando = 'Fora') AS goleadas_visitante
FROM {source} GROUP BY {by}"""


LAST_SEASON_GAMES = GAMES + """,
recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY temporada, clube
  ORDER BY data DESC, hora DESC, id_jogo DESC) rn FROM games) WHERE rn <= 10)"""


@query("a01_season_card", with_(GAMES, _card_sql("games", "temporada, clube")))
def a01(spark, sf):
    return results.season_card(games(spark, sf), SEASON_KEY)


@query("a02_last_10_card", with_(LAST_SEASON_GAMES, _card_sql("recent", "temporada, clube")))
def a02(spark, sf):
    return results.season_card(cg.last_n(games(spark, sf), 10, SEASON_KEY), SEASON_KEY)


@query("a03_clean_games_last_10", with_(LAST_SEASON_GAMES, """
SELECT temporada, clube, count(*) FILTER (WHERE gs = 0) AS clean_sheets,
       count(*) FILTER (WHERE gm = 0) AS clean_goals FROM recent GROUP BY temporada, clube"""))
def a03(spark, sf):
    return results.clean_games(cg.last_n(games(spark, sf), 10, SEASON_KEY), SEASON_KEY)


# --- A4 / A5 ---------------------------------------------------------------------
def _strength_sql(side: str) -> str:
    n = "count(*)"
    cents = "CAST(odd * 100 AS BIGINT)"
    return with_(GAMES + f""",
recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clube
  ORDER BY data DESC, hora DESC, id_jogo DESC) rn FROM games WHERE mando = '{side}')
  WHERE rn <= 10)""", f"""
SELECT clube, count(*) AS jogos, CAST(sum(venceu) AS BIGINT) AS vitorias,
  CAST(sum(empatou) AS BIGINT) AS empates, CAST(sum(perdeu) AS BIGINT) AS derrotas,
  CAST(sum(gm) AS BIGINT) AS gols_marcados, CAST(sum(gs) AS BIGINT) AS gols_sofridos,
  {pct('(sum(venceu) * 3 + sum(empatou))', f'({n} * 3)')} AS aproveitamento,
  {half_up('sum(gm)', n)} AS media_marcados, {half_up('sum(gs)', n)} AS media_sofridos,
  count(*) FILTER (WHERE gs = 0) AS clean_sheets, count(*) FILTER (WHERE gm = 0) AS clean_goals,
  coalesce({half_up(f'sum({cents})', '(100 * count(odd))')}, 0.0) AS odd_media,
  coalesce({half_up(f'(sum({cents}) FILTER (WHERE venceu = 1))',
                    '(100 * (count(odd) FILTER (WHERE venceu = 1)))')}, 0.0) AS odd_media_vitoria
FROM recent GROUP BY clube""")


@query("a04_home_strength", _strength_sql("Casa"))
def a04(spark, sf):
    return results.venue_strength(games(spark, sf), "Casa")


@query("a05_away_strength", _strength_sql("Fora"))
def a05(spark, sf):
    return results.venue_strength(games(spark, sf), "Fora")


# --- A6 / A7 ---------------------------------------------------------------------
def _duel_sql(last: int | None, where: str = "") -> str:
    cut = f"WHERE rn <= {last}" if last else ""
    oa = "CAST((CASE WHEN casa = ca THEN odd_casa ELSE odd_fora END) * 100 AS BIGINT)"
    ob = "CAST((CASE WHEN casa = ca THEN odd_fora ELSE odd_casa END) * 100 AS BIGINT)"
    ow = ("CAST((CASE WHEN gols_casa > gols_fora THEN odd_casa "
          "WHEN gols_fora > gols_casa THEN odd_fora END) * 100 AS BIGINT)")
    return with_(MATCHES + f""",
met AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ca, cb
  ORDER BY data DESC, hora DESC, id_jogo DESC) rn FROM (
    SELECT *, least(casa, fora) AS ca, greatest(casa, fora) AS cb FROM matches
    WHERE gols_casa IS NOT NULL AND gols_fora IS NOT NULL {where})) {cut})""", f"""
SELECT ca AS clube_a, cb AS clube_b, count(*) AS jogos,
  count(*) FILTER (WHERE (casa = ca AND gols_casa > gols_fora)
                      OR (fora = ca AND gols_fora > gols_casa)) AS vitorias_a,
  count(*) FILTER (WHERE gols_casa = gols_fora) AS empates,
  count(*) FILTER (WHERE (casa = cb AND gols_casa > gols_fora)
                      OR (fora = cb AND gols_fora > gols_casa)) AS vitorias_b,
  CAST(sum(CASE WHEN casa = ca THEN gols_casa ELSE gols_fora END) AS BIGINT) AS gols_a,
  CAST(sum(CASE WHEN casa = cb THEN gols_casa ELSE gols_fora END) AS BIGINT) AS gols_b,
  {half_up('sum(gols_casa + gols_fora)', 'count(*)')} AS media_gols,
  coalesce({half_up(f'sum({oa})', f'(100 * count({oa}))')}, 0.0) AS odd_media_a,
  coalesce({half_up(f'sum({ob})', f'(100 * count({ob}))')}, 0.0) AS odd_media_b,
  coalesce({half_up(f'sum({ow})', f'(100 * count({ow}))')}, 0.0) AS odd_media_vencedor
FROM met GROUP BY ca, cb""")


@query("a06_head_to_head", _duel_sql(None))
def a06(spark, sf):
    return results.head_to_head(views.matches(spark, sf))


@query("a07_head_to_head_last_10", _duel_sql(10))
def a07(spark, sf):
    return results.head_to_head(views.matches(spark, sf), n=10)


# --- A8 --------------------------------------------------------------------------
def _scoreline_sql(by: str, k: int | None, last: int | None = None, base: str = "shown") -> str:
    src = "(SELECT * FROM matches WHERE gols_casa IS NOT NULL AND gols_fora IS NOT NULL)"
    if last:
        src = (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY data DESC, "
               f"hora DESC, id_jogo DESC) r FROM {src}) WHERE r <= {last})")
    cut = f"WHERE rk <= {k}" if k else ""
    total = "todos" if base == "all" else f"sum(qtd) OVER (PARTITION BY {by})"
    return with_(MATCHES + f""",
counts AS (SELECT {by}, gols_casa || '-' || gols_fora AS placar, count(*) AS qtd
           FROM {src} GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY qtd DESC, placar) rk,
           sum(qtd) OVER (PARTITION BY {by}) AS todos FROM counts)""", f"""
SELECT {by}, placar, qtd, {pct('qtd', total)} AS prob FROM ranked {cut}""")


@query("a08_scorelines_home", _scoreline_sql("casa", 10))
def a08(spark, sf):
    return results.scorelines(views.matches(spark, sf))


@query("a08_scorelines_home_last_10", _scoreline_sql("casa", 10, 10))
def a08_last(spark, sf):
    return results.scorelines(views.matches(spark, sf), last=10)


@query("a08_scorelines_away", _scoreline_sql("fora", 10, None, "all"))
def a08_away(spark, sf):
    return results.scorelines(views.matches(spark, sf), ("fora",), denominator="all")


@query("a08_scorelines_away_last_10", _scoreline_sql("fora", 10, 10))
def a08_away_last(spark, sf):
    return results.scorelines(views.matches(spark, sf), ("fora",), last=10)


@query("a08_scorelines_duel", _scoreline_sql("casa, fora", None))
def a08_duel(spark, sf):
    return results.scorelines(views.matches(spark, sf), ("casa", "fora"), k=None)


@query("a08_scorelines_duel_any_venue", with_(MATCHES, f"""
SELECT casa, fora, placar, qtd, {pct('qtd', 'CAST(sum(qtd) OVER () AS BIGINT)')} AS prob FROM (
  SELECT 'BRAZIL' AS casa, 'CANADA' AS fora, CASE WHEN casa = 'BRAZIL' THEN gols_casa || '-' || gols_fora
    ELSE gols_fora || '-' || gols_casa END AS placar, count(*) AS qtd
  FROM matches WHERE gols_casa IS NOT NULL AND gols_fora IS NOT NULL
    AND ((casa = 'BRAZIL' AND fora = 'CANADA') OR (casa = 'CANADA' AND fora = 'BRAZIL')) GROUP BY 3)"""))
def a08_duel_any(spark, sf):
    return results.duel_scorelines(views.matches(spark, sf), "BRAZIL", "CANADA")


# --- A9 / A10 / A11 / W8 ---------------------------------------------------------
COUNTRY = GAMES + """,
country AS (SELECT clube, pais FROM (
  SELECT clube, pais, row_number() OVER (PARTITION BY clube
    ORDER BY (lower(pais) = 'mundo'), count(*) DESC, pais) rn
  FROM games WHERE pais IS NOT NULL GROUP BY clube, pais) WHERE rn = 1),
base AS (SELECT clube, count(*) AS jogos, CAST(sum(venceu) AS BIGINT) AS vitorias,
  CAST(sum(empatou) AS BIGINT) AS empates, CAST(sum(perdeu) AS BIGINT) AS derrotas,
  CAST(sum(gm) AS BIGINT) AS gols_marcados, CAST(sum(gs) AS BIGINT) AS gols_sofridos
  FROM games GROUP BY clube),
tab AS (SELECT *, gols_marcados - gols_sofridos AS saldo_gols, vitorias * 3 + empates AS pontos,
  """ + pct("(vitorias * 3 + empates)", "(jogos * 3)") + """ AS aproveitamento
  FROM base LEFT JOIN country USING (clube))"""


@query("a09_league_table", with_(COUNTRY, """
SELECT CAST(row_number() OVER (ORDER BY aproveitamento DESC, vitorias DESC, gols_marcados DESC,
  saldo_gols DESC, jogos, derrotas, gols_sofridos, clube) AS INTEGER) AS posicao, clube, pais, jogos,
  vitorias, empates, derrotas, gols_marcados, gols_sofridos, saldo_gols, pontos, aproveitamento
FROM tab"""))
def a09(spark, sf):
    return results.league_table(views.matches(spark, sf))


@query("a10_club_country", with_(COUNTRY, "SELECT clube, pais FROM country"))
def a10(spark, sf):
    return results.club_country(games(spark, sf))


@query("a11_best_attack_worst_defence", with_(COUNTRY, """
(SELECT 'ataque' AS lista, clube, pais, gols_marcados AS gols FROM tab
 ORDER BY gols DESC, clube LIMIT 10)
UNION ALL
(SELECT 'defesa', clube, pais, gols_sofridos FROM tab
 ORDER BY gols_sofridos DESC, clube LIMIT 10)"""))
def a11(spark, sf):
    table = results.league_table(views.matches(spark, sf))
    attack = cg.best(table, "gols_marcados", 10).select(
        F.lit("ataque").alias("lista"), "clube", "pais", F.col("gols_marcados").alias("gols"))
    defence = cg.best(table, "gols_sofridos", 10).select(
        F.lit("defesa").alias("lista"), "clube", "pais", F.col("gols_sofridos").alias("gols"))
    return attack.unionByName(defence)


# --- A12 / A13 / A14 / A15 -------------------------------------------------------
COMP_GOALS = MATCHES + """,
cgoals AS (SELECT campeonato, pais, CAST(sum(gols_casa + gols_fora) AS BIGINT) AS total_gols,
  count(*) AS jogos, """ + half_up("sum(gols_casa + gols_fora)", "count(*)") + """ AS media_gols
  FROM matches WHERE gols_casa IS NOT NULL AND gols_fora IS NOT NULL GROUP BY campeonato, pais)"""


@query("a12_competition_goals", with_(COMP_GOALS, "SELECT * FROM cgoals"))
def a12(spark, sf):
    return results.competition_goals(views.matches(spark, sf))


@query("a12_competition_most_goals", with_(COMP_GOALS, """
SELECT * FROM cgoals ORDER BY total_gols DESC, campeonato, pais LIMIT 10"""))
def a12_top(spark, sf):
    return results.most_goals(results.competition_goals(views.matches(spark, sf)))


@query("a13_highest_mean_goals", with_(COMP_GOALS, """
SELECT * FROM cgoals WHERE jogos >= 10 ORDER BY media_gols DESC, campeonato, pais LIMIT 10"""))
def a13(spark, sf):
    return results.highest_mean_goals(results.competition_goals(views.matches(spark, sf)))


def _band_sql() -> str:
    cases, names = [], fixed.ODDS_BAND_NAMES
    edges = ["1.01", "1.50", "2.00", "2.50", "3.00", "5.00", "10.00", "20.00", "30.00", "40.00", "50.00"]
    for i, name in enumerate(names):
        cond = f"odd <= {edges[i + 1]}" if i + 1 < len(edges) else "true"
        cases.append(f"WHEN {cond} THEN {i + 1}")
    label = " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(names))
    return with_(GAMES + f""",
b AS (SELECT *, CASE {' '.join(cases)} END AS ordem FROM games WHERE odd >= {edges[0]})""", f"""
SELECT CAST(ordem AS INTEGER) AS ordem, CASE ordem {label} END AS faixa_odd, count(*) AS total_jogos,
  CAST(sum(venceu) AS BIGINT) AS vitorias, CAST(count(*) - sum(venceu) AS BIGINT) AS derrotas,
  {pct('sum(venceu)', 'count(*)')} AS taxa_vitoria FROM b GROUP BY ordem""")


@query("a14_odds_bands", _band_sql())
def a14(spark, sf):
    return results.odds_bands(games(spark, sf))


def _competition_sql() -> str:
    def odds(col: str, cond: str = "true") -> str:
        return half_up(f"(sum(CAST({col} * 100 AS BIGINT)) FILTER (WHERE {cond}))",
                       f"(100 * (count({col}) FILTER (WHERE {cond})))")
    hw, aw = "gols_casa > gols_fora", "gols_fora > gols_casa"
    return with_(MATCHES + f""",
card AS (SELECT temporada, campeonato, pais, count(*) AS jogos,
  count(*) FILTER (WHERE {hw}) AS vitorias_casa, {odds('odd_casa')} AS odd_media_casa,
  {odds('odd_casa', hw)} AS odd_media_vitoria_casa, CAST(sum(gols_casa) AS BIGINT) AS gols_casa,
  count(*) FILTER (WHERE gols_casa = gols_fora) AS empates,
  count(*) FILTER (WHERE {aw}) AS vitorias_fora, {odds('odd_fora')} AS odd_media_fora,
  {odds('odd_fora', aw)} AS odd_media_vitoria_fora, CAST(sum(gols_fora) AS BIGINT) AS gols_fora
  FROM matches WHERE gols_casa IS NOT NULL AND gols_fora IS NOT NULL
  GROUP BY temporada, campeonato, pais)""", f"""
SELECT *, {pct('vitorias_casa', 'jogos')} AS prob_vitorias_casa,
  {half_up('gols_casa', 'jogos')} AS media_gols_casa,
  {pct('vitorias_fora', 'jogos')} AS prob_vitorias_fora,
  {half_up('gols_fora', 'jogos')} AS media_gols_fora, gols_casa + gols_fora AS gols,
  {half_up('(gols_casa + gols_fora)', 'jogos')} AS media_gols,
  coalesce({half_up('(CAST(round(odd_media_vitoria_casa * 100) AS BIGINT) + CAST(round(odd_media_vitoria_fora * 100) AS BIGINT))', '200')},
    odd_media_vitoria_casa, odd_media_vitoria_fora) AS odd_media_vencedor
FROM card""")


@query("a15_competition_card", _competition_sql())
def a15(spark, sf):
    return results.competition_card(views.matches(spark, sf))


# --- A16 .. A23: best and worst lists --------------------------------------------
def _extremes_sql(value: str, where: str = "true", k: int = 5) -> str:
    return with_(GAMES + f""",
t AS (SELECT clube, {value} AS valor FROM games WHERE {where} GROUP BY clube)""", f"""
(SELECT 'maior' AS lista, * FROM t ORDER BY valor DESC, clube LIMIT {k})
UNION ALL
(SELECT 'menor' AS lista, * FROM t ORDER BY valor, clube LIMIT {k})""")


def _extreme(name, value_sql, build, metric, where="true"):
    @query(name, _extremes_sql(value_sql, where))
    def run(spark, sf):
        return results.extremes(build(games(spark, sf)), metric)
    return run


_extreme("a16_wins", "CAST(sum(venceu) AS BIGINT)", results.club_counts, "vitorias")
_extreme("a17_losses", "CAST(sum(perdeu) AS BIGINT)", results.club_counts, "derrotas")
_extreme("a18_points_per_game_home", half_up("sum(pontos)", "count(*)"),
         lambda g: results.points_per_game(g, "Casa"), "pontuacao", "mando = 'Casa'")
_extreme("a19_points_per_game_away", half_up("sum(pontos)", "count(*)"),
         lambda g: results.points_per_game(g, "Fora"), "pontuacao", "mando = 'Fora'")
_extreme("a20_points_per_game", half_up("sum(pontos)", "count(*)"),
         results.points_per_game, "pontuacao")
_extreme("a21_goals_scored_total", "CAST(sum(gm) AS BIGINT)", results.goals_table, "total")
_extreme("a21_goals_scored_mean", half_up("sum(gm)", "count(*)"), results.goals_table, "media")
_extreme("a22_goals_conceded_total", "CAST(sum(gs) AS BIGINT)",
         lambda g: results.goals_table(g, "gols_sofridos"), "total")
_extreme("a22_goals_conceded_mean", half_up("sum(gs)", "count(*)"),
         lambda g: results.goals_table(g, "gols_sofridos"), "media")
_extreme("a23_clean_sheets", "count(*) FILTER (WHERE gs = 0)", results.clean_games, "clean_sheets")
_extreme("a23_clean_goals", "count(*) FILTER (WHERE gm = 0)", results.clean_games, "clean_goals")


@query("a23_clean_rates", with_(GAMES, f"""
SELECT temporada, clube, count(*) AS jogos, count(*) FILTER (WHERE gs = 0) AS clean_sheets,
  count(*) FILTER (WHERE gm = 0) AS clean_goals,
  {half_up('(count(*) FILTER (WHERE gs = 0))', 'count(*)')} AS tx_clean_sheets,
  {half_up('(count(*) FILTER (WHERE gm = 0))', 'count(*)')} AS tx_clean_goals
FROM games GROUP BY temporada, clube"""))
def a23_rates(spark, sf):
    return results.clean_games(games(spark, sf), SEASON_KEY, rates=True)


# --- W5 / W6 ---------------------------------------------------------------------
def _runs_sql(cond: str, by: str) -> str:
    return with_(GAMES + f""",
o AS (SELECT *, CASE WHEN {cond} THEN 1 ELSE 0 END AS ok,
  sum(CASE WHEN {cond} THEN 0 ELSE 1 END) OVER (PARTITION BY {by} ORDER BY data, hora, id_jogo
    ROWS UNBOUNDED PRECEDING) AS brk FROM games),
i AS (SELECT {by}, brk, CAST(sum(ok) AS BIGINT) AS n FROM o GROUP BY ALL)""", f"""
SELECT {by}, max(n) AS maior, arg_max(n, brk) AS atual FROM i GROUP BY {by}""")


@query("w05_unbeaten_runs", _runs_sql("gm >= gs", "clube"))
def w05(spark, sf):
    return streaks.runs(games(spark, sf), streaks.UNBEATEN)


@query("w06_winning_runs", _runs_sql("gm > gs", "clube"))
def w06(spark, sf):
    return streaks.runs(games(spark, sf), streaks.WINNING)


@query("w05_unbeaten_runs_by_season", _runs_sql("gm >= gs", "temporada, clube"))
def w05_season(spark, sf):
    return streaks.runs(games(spark, sf), streaks.UNBEATEN, SEASON_KEY)


# --- R4 / R5: report layouts -----------------------------------------------------
@query("r04_card_rows", with_(GAMES + f""",
c AS ({_card_sql('games', 'temporada, clube')})""", " UNION ALL ".join(
    f"SELECT temporada, clube, {i} AS ordem, '{label}' AS informacao, "
    + (f"coalesce(printf('%.2f', {col}), '')" if dec else f"coalesce(CAST({col} AS VARCHAR), '')")
    + " AS dados FROM c"
    for i, (label, col, dec) in enumerate(fixed.SEASON_CARD, start=1))))
def r04(spark, sf):
    card = results.season_card(games(spark, sf), SEASON_KEY)
    return reports.card_rows(card, fixed.SEASON_CARD, SEASON_KEY)


@query("r05_side_by_side", with_(GAMES + f""",
c AS ({_card_sql('games', 'clube')})""", " UNION ALL ".join(
    f"SELECT {i} AS ordem, '{label}' AS informacao, "
    + ", ".join(
        "max(CASE WHEN clube = '" + club + "' THEN "
        + (f"coalesce(printf('%.2f', {col}), '')" if dec else f"coalesce(CAST({col} AS VARCHAR), '')")
        + f" END) AS \"{club}\"" for club in ("NATION_3", "NATION_7"))
    + " FROM c"
    for i, (label, col, dec) in enumerate(fixed.SEASON_CARD, start=1))))
def r05(spark, sf):
    card = results.season_card(games(spark, sf))
    lines = reports.card_rows(card, fixed.SEASON_CARD, ("clube",))
    return reports.side_by_side(lines, ["NATION_3", "NATION_7"])
