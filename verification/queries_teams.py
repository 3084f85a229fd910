"""Registered queries over team statistics and table scopes."""

from pyspark.sql import functions as F

from pitchlake.functions import fixed
from pitchlake.operators import team_stats as ts
from pitchlake.sources import tables
from verification import views
from verification.oracle_views import MATCHES, PLAYERS, STATS
from verification.queries_players import recent_players
from verification.registry import half_up, pct, query, with_

AS_OF = "1997-06-15"

# Text metrics as exact integers: possession in tenths of a percent.
POSS10 = ("TRY_CAST(replace(replace(ball_possession, '%', ''), ',', '.') AS DECIMAL(9,3))")
TYPED = STATS + f""",
t AS (SELECT s.* EXCLUDE (ball_possession, duels, tackles_won, expected_goals),
  CAST({POSS10} * 10 AS BIGINT) AS poss10,
  CAST(replace(duels, '%', '') AS BIGINT) AS duels,
  CAST(replace(tackles_won, '%', '') AS BIGINT) AS tackles_won,
  CAST(round(expected_goals * 100) AS BIGINT) AS xg100,
  m.data, m.hora, m.campeonato, m.pais, m.casa, m.fora
  FROM team_stats s JOIN matches m USING (id_jogo))"""


def scoped(spark, sf, periodo=None):
    return tables.team_stats_of(
        views.team_stats(spark, sf), views.matches(spark, sf), periodo
    )


# --- S1 .. S8 ------------------------------------------------------------------
_MATCH_COLS = ["id_jogo", "casa", "fora", "gols_casa", "gols_fora", "temporada", "campeonato"]


def _scan(name, where, build):
    @query(name, with_(MATCHES, f"""
SELECT {', '.join(_MATCH_COLS)}, CAST(data AS VARCHAR) AS data FROM matches WHERE {where}"""))
    def run(spark, sf):
        return build(views.matches(spark, sf)).select(
            *_MATCH_COLS, F.col("data").cast("string").alias("data"))
    return run


_scan("s01_matches_of_clubs",
      "casa IN ('NATION_3', 'NATION_7') OR fora IN ('NATION_3', 'NATION_7')",
      lambda m: tables.matches_of(m, ["NATION_3", "NATION_7"]))
_scan("s02_matches_of_competition",
      "temporada = '1997' AND campeonato = '1-URGENT' AND pais = 'ASIA'",
      lambda m: tables.matches_in(m, "1997", "1-URGENT", "ASIA"))
_scan("s03_matches_previous_month", "data >= DATE '1997-05-01' AND data < DATE '1997-06-01'",
      lambda m: tables.matches_prev_month(m, AS_OF))
_scan("s04_matches_between",
      "(casa = 'NATION_3' AND fora = 'NATION_7') OR (casa = 'NATION_7' AND fora = 'NATION_3')",
      lambda m: tables.matches_between(m, "NATION_3", "NATION_7"))


@query("s05_team_stats_with_context", with_(STATS, """
SELECT id_jogo, periodo, clube, CAST(data AS VARCHAR) AS data, campeonato, ball_possession,
  total_shots, CASE WHEN clube = casa THEN 'Casa' WHEN clube = fora THEN 'Fora'
  ELSE 'Verificar' END AS mando FROM team_stats JOIN matches USING (id_jogo)"""))
def s05(spark, sf):
    return scoped(spark, sf).select(
        "id_jogo", "periodo", "clube", F.col("data").cast("string").alias("data"), "campeonato",
        "ball_possession", "total_shots", "mando")


@query("s06_player_stats_with_context", with_(PLAYERS, """
SELECT id_jogo, player_id, name, team, position, CAST(data AS VARCHAR) AS data,
  CASE WHEN team = casa THEN 'Casa' ELSE 'Fora' END AS mando, minutes AS minutes_played,
  goals FROM pl"""))
def s06(spark, sf):
    return tables.player_stats_of(views.player_stats(spark, sf), views.matches(spark, sf)).select(
        "id_jogo", "player_id", "name", "team", "position",
        F.col("data").cast("string").alias("data"), "mando", "minutes_played", "goals")


@query("s07_stats_of_both_sides", with_(STATS, """
SELECT id_jogo, periodo, clube, total_shots FROM team_stats WHERE EXISTS (
  SELECT 1 FROM matches m WHERE m.id_jogo = team_stats.id_jogo
  AND (casa IN ('NATION_3', 'NATION_7') OR fora IN ('NATION_3', 'NATION_7')))"""))
def s07(spark, sf):
    return tables.team_stats_both_sides(
        views.team_stats(spark, sf), views.matches(spark, sf), ["NATION_3", "NATION_7"]
    ).select("id_jogo", "periodo", "clube", "total_shots")


@query("s08_half_stats_with_opponent", with_(STATS, """
SELECT id_jogo, clube, total_shots, CASE WHEN clube = casa THEN fora ELSE casa END AS adversario,
  CASE WHEN clube = casa THEN 'Casa' ELSE 'Fora' END AS mando
FROM team_stats JOIN matches USING (id_jogo) WHERE periodo = '1ST'"""))
def s08(spark, sf):
    return scoped(spark, sf, "1ST").select("id_jogo", "clube", "total_shots", "adversario", "mando")


# --- T1 ------------------------------------------------------------------------
def _period_card_sql() -> str:
    n = "count(*)"
    s = lambda c: f"sum({c})"
    sums = {
        "grandes_chances": "big_chances", "grandes_chances_convertidas": "big_chances_scored",
        "finalizacoes": "total_shots", "finalizacoes_certas": "shots_on_target",
        "finalizacoes_area": "shots_inside_box", "bolas_trave": "hit_woodwork",
        "escanteios": "corner_kicks", "passes": "passes", "passes_certos": "accurate_passes",
        "entradas_terco_final": "final_third_entries",
        "faltas_terco_final": "fouled_in_final_third", "perdas_bola": "dispossessed",
        "amarelos": "yellow_cards",
    }
    per_game = {
        "grandes_chances_jogo": "big_chances", "finalizacoes_jogo": "total_shots",
        "finalizacoes_certas_jogo": "shots_on_target", "finalizacoes_area_jogo": "shots_inside_box",
        "escanteios_jogo": "corner_kicks", "entradas_terco_final_jogo": "final_third_entries",
        "perdas_bola_jogo": "dispossessed",
    }
    shares = {
        "aproveitamento_grandes_chances": ("big_chances_scored", "big_chances"),
        "acerto_finalizacoes": ("shots_on_target", "total_shots"),
        "perc_finalizacoes_area": ("shots_inside_box", "total_shots"),
        "assertividade_passes": ("accurate_passes", "passes"),
    }
    cols = [
        "count(*) AS jogos",
        f"{half_up('sum(poss10)', '(10 * count(poss10))')} AS posse_bola",
        f"{half_up('sum(xg100)', '(100 * count(xg100))')} AS xg_medio",
        "coalesce(CAST(sum(xg100) AS BIGINT), 0) / 100.0::DOUBLE AS xg_total",
        f"{half_up('sum(duels)', 'count(duels)')} AS duelos_ganhos",
        *[f"CAST(sum({c}) AS BIGINT) AS {name}" for name, c in sums.items()],
        *[f"{half_up(s(c), n)} AS {name}" for name, c in per_game.items()],
        *[f"{pct(s(a), s(b))} AS {name}" for name, (a, b) in shares.items()],
    ]
    return with_(TYPED + """,
recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY periodo, temporada, clube
  ORDER BY data DESC, hora DESC, id_jogo DESC) rn FROM t) WHERE rn <= 10),
red AS (SELECT periodo, temporada, clube, CAST(sum(red_cards) AS BIGINT) AS r
  FROM recent GROUP BY ALL),
card AS (SELECT periodo, temporada, clube, """ + ",\n  ".join(cols) + """
  FROM recent GROUP BY periodo, temporada, clube)""", """
SELECT card.*, CASE WHEN card.periodo = 'ALL' THEN
    (SELECT CAST(coalesce(sum(r), 0) AS BIGINT) FROM red WHERE red.periodo <> 'ALL'
     AND red.temporada = card.temporada AND red.clube = card.clube)
  ELSE (SELECT coalesce(r, 0) FROM red WHERE red.periodo = card.periodo
     AND red.temporada = card.temporada AND red.clube = card.clube) END AS vermelhos
FROM card""")


@query("t01_period_card", _period_card_sql())
def t01(spark, sf):
    return ts.period_card(scoped(spark, sf))


# --- T2 .. T7 leaderboards -------------------------------------------------------
def month_stats(spark, sf):
    rows = tables.team_stats_of(
        views.team_stats(spark, sf),
        tables.matches_prev_month(views.matches(spark, sf), AS_OF),
    )
    return tables.without_friendlies(rows)


MONTH = TYPED + """,
month AS (SELECT * FROM t WHERE data >= DATE '1997-05-01' AND data < DATE '1997-06-01'
  AND campeonato NOT IN ('Eliminatórias', 'Amistoso'))"""


def _board(src, metrics: dict, having="true", k=10, by="periodo", direction="DESC",
           keep="true") -> str:
    """metrics: name -> SQL value aggregated over ``src`` grouped by (by, clube)."""
    parts = "\nUNION ALL\n".join(
        f"SELECT {by}, clube, '{m}' AS metrica, CAST({v} AS DOUBLE) AS valor "
        f"FROM {src} GROUP BY {by}, clube HAVING {having}" for m, v in metrics.items())
    return f"""
SELECT {by}, clube, metrica, valor, CAST(posicao AS INTEGER) AS posicao FROM (
  SELECT *, row_number() OVER (PARTITION BY {by}, metrica ORDER BY valor {direction}, clube) posicao
  FROM ({parts}) WHERE valor IS NOT NULL AND {keep}) WHERE posicao <= {k}"""


POSSESSION = {"ball_possession": half_up("sum(poss10)", "(10 * count(poss10))")}


@query("t02_monthly_possession", with_(MONTH, _board("month", POSSESSION, "count(*) > 2")))
def t02(spark, sf):
    return ts.leaderboard(month_stats(spark, sf), ["ball_possession"], "mean", min_games=3)


@query("t02_monthly_duels_won", with_(MONTH, _board(
    "month", {"duels": "sum(duels) // count(duels)"}, "count(*) > 2")))
def t02_duels(spark, sf):
    return ts.leaderboard(month_stats(spark, sf), ["duels"], "mean", min_games=3, truncate=True)


XG_MEAN = {"expected_goals": half_up("sum(xg100)", "(100 * count(xg100))")}


@query("t03_monthly_xg", with_(MONTH, _board("month", XG_MEAN)))
def t03(spark, sf):
    return ts.leaderboard(month_stats(spark, sf), ["expected_goals"], "mean")


@query("t04_monthly_totals", with_(MONTH, _board(
    "month", {m: f"sum({m})" for m in fixed.MONTHLY_SUM_METRICS})))
def t04(spark, sf):
    return ts.leaderboard(month_stats(spark, sf), fixed.MONTHLY_SUM_METRICS)


@query("t04_all_time_totals", with_(TYPED, _board(
    "t", {m: f"sum({m})" for m in fixed.MONTHLY_SUM_METRICS})))
def t04_all(spark, sf):
    return ts.leaderboard(scoped(spark, sf), fixed.MONTHLY_SUM_METRICS)


@query("t05_red_cards", with_(TYPED + """,
h AS (SELECT temporada, clube, periodo, CAST(sum(red_cards) AS BIGINT) AS vermelhos FROM t
  WHERE periodo <> 'ALL' GROUP BY ALL),
u AS (SELECT * FROM h UNION ALL
  SELECT temporada, clube, 'ALL', CAST(sum(vermelhos) AS BIGINT) FROM h GROUP BY ALL)""", """
SELECT temporada, periodo, clube, vermelhos, CAST(posicao AS INTEGER) AS posicao FROM (
  SELECT *, row_number() OVER (PARTITION BY temporada, periodo ORDER BY vermelhos DESC, clube) posicao
  FROM u WHERE vermelhos > 1) WHERE posicao <= 10"""))
def t05(spark, sf):
    return ts.red_card_leaders(scoped(spark, sf), by=("temporada",))


FULL = TYPED + ", f AS (SELECT * FROM t WHERE periodo = 'ALL')"
COMP_TRUNC = ["total_shots", "shots_on_target", "shots_inside_box", "final_third_entries"]
COMP_MEAN = ["big_chances", "goalkeeper_saves"]
BY_COMP = ("campeonato",)


@query("t06_competition_means_truncated", with_(FULL, _board(
    "f", {m: f"sum({m}) // count({m})" for m in COMP_TRUNC}, by="campeonato")))
def t06(spark, sf):
    return ts.leaderboard(scoped(spark, sf, "ALL"), COMP_TRUNC, "mean", by=BY_COMP, truncate=True)


@query("t06_competition_means", with_(FULL, _board(
    "f", POSSESSION | XG_MEAN | {m: half_up(f"sum({m})", f"count({m})") for m in COMP_MEAN},
    by="campeonato")))
def t06_means(spark, sf):
    return ts.leaderboard(
        scoped(spark, sf, "ALL"), ["ball_possession", "expected_goals", *COMP_MEAN], "mean",
        by=BY_COMP)


@query("t06_competition_lowest_xg", with_(FULL, _board(
    "f", XG_MEAN, by="campeonato", direction="ASC")))
def t06_low(spark, sf):
    return ts.leaderboard(
        scoped(spark, sf, "ALL"), ["expected_goals"], "mean", by=BY_COMP, largest=False)


def _share100(a: str, b: str) -> str:
    return f"CAST(round({half_up(a, b, factor=100)} * 100) AS BIGINT)"


@query("t07_competition_ratios", with_(FULL + f""",
g AS (SELECT campeonato, clube, {_share100('shots_on_target', 'total_shots')} AS a,
  {_share100('big_chances_scored', 'big_chances')} AS b,
  {_share100('accurate_passes', 'passes')} AS c FROM f)""", _board("g", {
    "finalizacoes": half_up("sum(a)", "(100 * count(a))"),
    "grandes_chances": half_up("sum(b)", "(100 * count(b))"),
    "passes": half_up("sum(c)", "(100 * count(c))")}, by="campeonato")))
def t07(spark, sf):
    return ts.ratio_leaderboard(scoped(spark, sf, "ALL"), by=BY_COMP)


# --- T8 .. T13 -------------------------------------------------------------------
FACED = STATS + f""",
recent AS (SELECT temporada, clube AS clube_analise, id_jogo, gm, gs FROM (
  SELECT *, row_number() OVER (PARTITION BY temporada, clube
    ORDER BY data DESC, hora DESC, id_jogo DESC) rn FROM games) WHERE rn <= 10),
fx AS (SELECT r.temporada, r.clube_analise, r.gm, r.gs, s.clube = r.clube_analise AS own,
  s.* EXCLUDE (temporada, expected_goals), CAST({POSS10} * 10 AS BIGINT) AS poss10,
  CAST(replace(s.duels, '%', '') AS BIGINT) AS duels_n,
  CAST(replace(s.tackles_won, '%', '') AS BIGINT) AS tackles_n,
  CAST(round(s.expected_goals * 100) AS BIGINT) AS xg100,
  CAST(split_part(crosses, '/', 1) AS BIGINT) AS cr_w,
  CAST(regexp_extract(crosses, '/(\\d+)', 1) AS BIGINT) AS cr_t,
  CAST(regexp_extract(long_balls, '/(\\d+)', 1) AS BIGINT) AS lb_t,
  CAST(split_part(ground_duels, '/', 1) AS BIGINT) AS gd_w,
  CAST(regexp_extract(ground_duels, '/(\\d+)', 1) AS BIGINT) AS gd_t,
  CAST(split_part(aerial_duels, '/', 1) AS BIGINT) AS ad_w,
  CAST(regexp_extract(aerial_duels, '/(\\d+)', 1) AS BIGINT) AS ad_t
  FROM team_stats s JOIN recent r USING (id_jogo) WHERE periodo = 'ALL')"""


def _agg(fn: str, c: str, own: bool) -> str:
    return f"({fn}({c}) FILTER (WHERE {'own' if own else 'NOT own'}))"


def _mean(c: str, own: bool = True, scale: int = 1) -> str:
    return half_up(_agg("sum", c, own), f"({scale} * {_agg('count', c, own)})")


def _ratio(a: str, b: str, own: bool = True, factor: int = 1, scale: int = 1) -> str:
    return half_up(_agg("sum", a, own), f"({scale} * {_agg('sum', b, own)})", factor=factor)


def _profile(cols: dict, outer: str = "*") -> str:
    inner = ",\n  ".join(f"{v} AS {k}" for k, v in cols.items())
    return with_(FACED, f"""SELECT {outer} FROM (
SELECT temporada, clube_analise, {inner} FROM fx GROUP BY temporada, clube_analise)""")


JOGOS = {"jogos": "count(*) FILTER (WHERE own)"}


def _minus(a: str, b: str) -> str:
    return (f"(CAST(round({a} * 100) AS BIGINT) - CAST(round({b} * 100) AS BIGINT)) "
            "/ 100.0::DOUBLE")


def faced(spark, sf):
    return ts.faced(views.team_stats(spark, sf), views.matches(spark, sf))


@query("t08_chances_for_and_against", _profile(JOGOS | {
    "xg_favor": _mean("xg100", True, 100), "xg_contra": _mean("xg100", False, 100),
    "grandes_chances_favor": _mean("big_chances"),
    "grandes_chances_contra": _mean("big_chances", False),
    "conversao_favor": _ratio("big_chances_scored", "big_chances", True, 100),
    "conversao_contra": _ratio("big_chances_scored", "big_chances", False, 100),
    "chances_perdidas_favor": _mean("big_chances_missed"),
    "chances_perdidas_contra": _mean("big_chances_missed", False),
    "gols_marcados_jogo": _mean("gm"), "gols_sofridos_jogo": _mean("gs"),
}, "*, " + ", ".join([
    _minus("xg_favor", "xg_contra") + " AS saldo_xg",
    _minus("gols_marcados_jogo", "xg_favor") + " AS gols_menos_xg_favor",
    _minus("gols_sofridos_jogo", "xg_contra") + " AS gols_menos_xg_contra"])))
def t08(spark, sf):
    return ts.chances_profile(faced(spark, sf))


@query("t09_attack_profile", _profile(JOGOS | {
    "chutes_jogo": _mean("total_shots"), "chutes_alvo_jogo": _mean("shots_on_target"),
    "chutes_fora_jogo": _mean("shots_off_target"),
    "chutes_bloqueados_jogo": _mean("blocked_shots"),
    "perc_dentro_area": _ratio("shots_inside_box", "total_shots", True, 100),
    "perc_fora_area": _ratio("shots_outside_box", "total_shots", True, 100),
    "xg_por_chute_favor": _ratio(
        "xg100", "CASE WHEN xg100 IS NOT NULL THEN total_shots END", True, 1, 100),
    "xg_por_chute_contra": _ratio(
        "xg100", "CASE WHEN xg100 IS NOT NULL THEN total_shots END", False, 1, 100),
    "trave_favor": f"CAST({_agg('sum', 'hit_woodwork', True)} AS BIGINT)",
    "trave_contra": f"CAST({_agg('sum', 'hit_woodwork', False)} AS BIGINT)",
    "passes_profundidade_jogo": _mean("through_balls"),
    "entradas_favor": _mean("final_third_entries"),
    "entradas_contra": _mean("final_third_entries", False),
    "faltas_terco_final": _mean("fouled_in_final_third"),
    "escanteios_favor": _mean("corner_kicks"), "escanteios_contra": _mean("corner_kicks", False),
    "acuracia_cruzamentos": _mean(_share100("cr_w", "cr_t"), True, 100),
    "cruzamentos_por_entrada": _ratio("cr_t", "final_third_entries", True, 100),
    "perc_bolas_longas": _ratio("lb_t", "passes", True, 100),
    "bola_parada_jogo": _mean("corner_kicks + fouled_in_final_third"),
}))
def t09(spark, sf):
    return ts.attack_profile(faced(spark, sf))


@query("t10_possession_profile", _profile(JOGOS | {
    "posse_bola": _mean("poss10", True, 10), "passes_jogo": _mean("passes"),
    "acerto_passes": _ratio("accurate_passes", "passes", True, 100),
    "perc_bolas_longas": _ratio("lb_t", "passes", True, 100),
    "profundidade_por_100": _ratio("through_balls", "passes", True, 100),
}))
def t10(spark, sf):
    return ts.possession_profile(faced(spark, sf))


@query("t11_defence_profile", _profile(JOGOS | {
    "chutes_sofridos_jogo": _mean("total_shots", False), "bloqueios_jogo": _mean("blocked_shots"),
    "desarmes_jogo": _mean("tackles"), "perc_desarmes_ganhos": _mean("tackles_n"),
    "interceptacoes_jogo": _mean("interceptions"), "recuperacoes_jogo": _mean("recoveries"),
    "cortes_jogo": _mean("clearances"), "perdas_jogo": _mean("dispossessed"),
}))
def t11(spark, sf):
    return ts.defence_profile(faced(spark, sf))


@query("t12_duel_profile", _profile(JOGOS | {
    "duelos_ganhos": _mean("duels_n"),
    "duelos_chao": _mean(_share100("gd_w", "gd_t"), True, 100),
    "duelos_aereos": _mean(_share100("ad_w", "ad_t"), True, 100),
}))
def t12(spark, sf):
    return ts.duel_profile(faced(spark, sf))


@query("t13_pressing_index", _profile(JOGOS | {
    "indice_pressao": half_up(
        _agg("sum", "passes", False),
        _agg("sum", "tackles + interceptions + recoveries + clearances", True)),
}))
def t13(spark, sf):
    return ts.pressing_index(faced(spark, sf))


@query("t14_yellow_cards", _profile(
    {"amarelos": f"CAST({_agg('sum', 'yellow_cards', True)} AS BIGINT)"}))
def t14(spark, sf):
    return ts.yellow_cards(faced(spark, sf))


@query("t14_player_discipline", with_(recent_players("temporada, team"), f"""
SELECT temporada, team, count(DISTINCT id_jogo) AS jogos,
  {half_up('sum(fouls)', 'count(DISTINCT id_jogo)')} AS faltas_jogo,
  {half_up('sum(penalties)', 'count(DISTINCT id_jogo)')} AS penaltis_cometidos_jogo,
  {half_up('sum(error_shot)', 'count(DISTINCT id_jogo)')} AS erros_finalizacao_jogo,
  {half_up('sum(error_goal)', 'count(DISTINCT id_jogo)')} AS erros_gol_jogo
FROM recent GROUP BY temporada, team"""))
def t14_players(spark, sf):
    from verification.queries_players import recent_rows

    return ts.player_discipline(recent_rows(spark, sf, ("temporada", "team")))
