"""Registered queries over player statistics and goals."""

from pyspark.sql import functions as F

from pitchlake.operators import players as pl
from pitchlake.sources import tables
from verification import views
from verification.oracle_views import GOALS, PLAYERS
from verification.registry import half_up, query, with_

AS_OF = "1997-06-15"
KEY = "player_id, name, position, team"


def rows(spark, sf):
    return tables.player_stats_of(views.player_stats(spark, sf), views.matches(spark, sf))


def recent_rows(spark, sf, by=("team",)):
    return pl.in_recent_games(rows(spark, sf), 10, by)


def recent_players(by: str = "team", source: str = "pl", ctes: str = PLAYERS) -> str:
    keys = by.split(", ")
    same = " AND ".join(f"p.{k} = g.{k}" for k in keys)
    return ctes + f""",
recent AS (SELECT p.* FROM {source} p JOIN (
  SELECT {by}, id_jogo FROM (SELECT {by}, id_jogo, row_number() OVER (PARTITION BY {by}
    ORDER BY data DESC, hora DESC, id_jogo DESC) rn
    FROM (SELECT DISTINCT {by}, id_jogo, data, hora FROM {source})) WHERE rn <= 10) g
  ON {same} AND p.id_jogo = g.id_jogo)"""


VALUES = {
    "minutes_played": "CAST(sum(minutes) AS BIGINT)",
    "goals": "CAST(sum(goals) AS BIGINT)",
    "goal_assist": "CAST(sum(assists) AS BIGINT)",
    "participacao": "CAST(sum(goals + assists) AS BIGINT)",
    "rating": "coalesce(CAST(sum(rating10) AS BIGINT), 0) / 10.0::DOUBLE",
    "big_chance_created": "CAST(sum(chances) AS BIGINT)",
    "key_pass": "CAST(sum(key_pass) AS BIGINT)",
    "expected_goals": "coalesce(CAST(sum(xg100) AS BIGINT), 0) / 100.0::DOUBLE",
}
MEANS = {
    "rating": half_up("sum(rating10)", "(10 * count(rating10))"),
    "expected_goals": half_up("sum(xg100)", "(100 * count(xg100))"),
    "touches": half_up("sum(touches)", "count(touches)"),
    "total_pass": half_up("sum(total_pass)", "count(total_pass)"),
    "accurate_pass": half_up("sum(accurate_pass)", "count(accurate_pass)"),
}


def _ranked(inner: str, k: int, per: str = "", above: str = "true", cols: str = KEY) -> str:
    order = "valor DESC NULLS LAST, name, player_id, position, team"
    if not per:
        return f"SELECT {cols}, valor FROM ({inner}) WHERE {above} ORDER BY {order} LIMIT {k}"
    return f"""SELECT {cols}, valor, CAST(posicao AS INTEGER) AS posicao FROM (
  SELECT *, row_number() OVER (PARTITION BY {per} ORDER BY {order}) posicao
  FROM ({inner}) WHERE {above}) WHERE posicao <= {k}"""


def _totals(value: str, src: str, by: str = KEY, extra: str = "") -> str:
    return f"SELECT {by}, {value} AS valor{extra} FROM {src} GROUP BY {by}"


# --- L1 .. L11: last 10 games of each team ----------------------------------------
def _recent_leaders(name, metric, how="sum", k=10, per=(), above=None):
    value = VALUES[metric] if how == "sum" else MEANS[metric]
    keep = "true" if above is None else f"valor > {above}"

    @query(name, with_(recent_players(), _ranked(
        _totals(value, "recent"), k, ", ".join(per), keep)))
    def run(spark, sf):
        table = pl.totals(recent_rows(spark, sf), metric, how)
        return pl.leaders(table, k, per, above)
    return run


TEAM = ("team",)
_recent_leaders("l01_minutes_top_5_per_club", "minutes_played", k=5, per=TEAM)
_recent_leaders("l02_goals", "goals", above=0)
_recent_leaders("l03_assists", "goal_assist", above=0)
_recent_leaders("l04_goal_involvement", "participacao", above=0)
_recent_leaders("l05_rating_total_top_5_per_club", "rating", k=5, per=TEAM, above=0)
_recent_leaders("l07_big_chances_created", "big_chance_created", above=0)
_recent_leaders("l08_key_passes", "key_pass", above=0)
_recent_leaders("l09_xg_total", "expected_goals", above=0)
_recent_leaders("l10_xg_mean", "expected_goals", "mean", above=0)
_recent_leaders("l11_goals_by_club", "goals", per=TEAM, above=0)
_recent_leaders("l11_assists_by_club", "goal_assist", per=TEAM, above=0)
_recent_leaders("l11_goal_involvement_by_club", "participacao", per=TEAM, above=0)
_recent_leaders("l11_big_chances_by_club", "big_chance_created", per=TEAM, above=0)
_recent_leaders("l11_key_passes_by_club", "key_pass", per=TEAM, above=0)
_recent_leaders("l11_xg_total_by_club", "expected_goals", per=TEAM, above=0)
_recent_leaders("l11_xg_mean_by_club", "expected_goals", "mean", per=TEAM, above=0)


def _with_minutes(name, per):
    @query(name, with_(recent_players(), _ranked(
        _totals(MEANS["rating"], "recent", KEY, ", CAST(sum(minutes) AS BIGINT) AS minutos"),
        10, ", ".join(per), "minutos >= 90", KEY + ", minutos")))
    def run(spark, sf):
        table = pl.totals(recent_rows(spark, sf), "rating", "mean", with_minutes=True)
        return pl.leaders(table, 10, per, min_minutes=90)
    return run


_with_minutes("l06_rating_mean", ())
_with_minutes("l11_rating_mean_by_club", TEAM)


# --- L12 .. L14: previous month, overall and per position --------------------------
MONTH = PLAYERS + """,
month AS (SELECT * FROM pl WHERE data >= DATE '1997-05-01' AND data < DATE '1997-06-01')"""


def month_rows(spark, sf):
    return tables.player_stats_of(
        views.player_stats(spark, sf), tables.matches_prev_month(views.matches(spark, sf), AS_OF))


def _teams(metric: str, src: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return (f"SELECT {lead}player_id, name, position, string_agg(DISTINCT team, ', ' ORDER BY team) "
            f"AS team, {VALUES[metric]} AS valor FROM {src} GROUP BY {lead}player_id, name, position")


def _month_leaders(name, metric, per=(), above=None):
    keep = "true" if above is None else f"valor > {above}"

    @query(name, with_(MONTH, _ranked(_teams(metric, "month"), 10, ", ".join(per), keep)))
    def run(spark, sf):
        return pl.leaders(pl.with_teams(month_rows(spark, sf), metric), 10, per, above)
    return run


POSITION = ("position",)
_month_leaders("l12_monthly_minutes", "minutes_played")
_month_leaders("l12_monthly_minutes_by_position", "minutes_played", POSITION)
_month_leaders("l13_monthly_goals", "goals", above=0)
_month_leaders("l13_monthly_goals_by_position", "goals", POSITION, 0)
_month_leaders("l14_monthly_assists", "goal_assist", above=0)
_month_leaders("l14_monthly_assists_by_position", "goal_assist", POSITION, 0)


@query("l12_all_time_minutes_with_teams", with_(PLAYERS, _teams("minutes_played", "pl")))
def l12_all(spark, sf):
    return pl.with_teams(rows(spark, sf), "minutes_played")


# --- L15 .. L18: competitions -------------------------------------------------------
COMP_KEY = "campeonato, " + KEY


def _comp_leaders(name, metric, per=("campeonato",), above=None):
    keep = "true" if above is None else f"valor > {above}"

    @query(name, with_(PLAYERS, _ranked(
        _totals(VALUES[metric], "pl", COMP_KEY), 10, ", ".join(per), keep, COMP_KEY)))
    def run(spark, sf):
        table = pl.totals(rows(spark, sf), metric, by=("campeonato", *pl.PLAYER))
        return pl.leaders(table, 10, per, above)
    return run


_comp_leaders("l15_competition_minutes_by_position", "minutes_played", ("campeonato", "position"))
_comp_leaders("l16_competition_goals", "goals", above=0)
_comp_leaders("l16_competition_assists", "goal_assist", above=0)
_comp_leaders("l16_competition_goal_involvement", "participacao", above=0)
_comp_leaders("l16_competition_big_chances", "big_chance_created", above=0)
_comp_leaders("l16_competition_key_passes", "key_pass", above=0)
_comp_leaders("l17_competition_rating_total", "rating", above=0)
_comp_leaders("l17_competition_xg_total", "expected_goals", above=1)


def _regulars(name, metric):
    inner = _totals(MEANS[metric], "pl", COMP_KEY, ", CAST(sum(minutes) AS BIGINT) AS minutos")

    @query(name, with_(PLAYERS + f""",
w AS ({inner}), m AS (SELECT campeonato, max(minutos) AS most FROM w GROUP BY campeonato)""",
        _ranked("SELECT w.* FROM w JOIN m USING (campeonato) WHERE minutos * 100 >= most * 40",
                10, "campeonato", "valor > 0", COMP_KEY + ", minutos")))
    def run(spark, sf):
        return pl.leaders(pl.regulars(rows(spark, sf), metric), 10, ("campeonato",), above=0)
    return run


_regulars("l18_competition_rating_mean", "rating")
_regulars("l18_competition_xg_mean", "expected_goals")


# --- L19 / L20 ------------------------------------------------------------------
LINEUP = recent_players("team", "st", PLAYERS + """,
st AS (SELECT * FROM pl WHERE NOT substitute)""") + """,
lineup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY team
    ORDER BY jogos_titular DESC, name, player_id, position) rn
  FROM (SELECT player_id, name, position, team, count(*) AS jogos_titular FROM recent GROUP BY ALL))
  WHERE rn <= 11)"""


@query("l19_probable_lineup", with_(LINEUP, """
SELECT player_id, name, position, team, jogos_titular,
  CASE position WHEN 'Goleiro' THEN 1 WHEN 'Defensor' THEN 2 WHEN 'Meio-campo' THEN 3
  WHEN 'Atacante' THEN 4 ELSE 5 END AS ordem FROM lineup"""))
def l19(spark, sf):
    return pl.probable_lineup(rows(spark, sf))


@query("l20_formation", with_(LINEUP, """
SELECT team, count(*) FILTER (WHERE position = 'Defensor') || '-' ||
  count(*) FILTER (WHERE position = 'Meio-campo') || '-' ||
  count(*) FILTER (WHERE position = 'Atacante') AS formacao FROM lineup GROUP BY team"""))
def l20(spark, sf):
    return pl.formation(pl.probable_lineup(rows(spark, sf)))


# --- L21 / L22: season lists ------------------------------------------------------
def _season_leaders(name, metric, how="sum", k=10):
    value = VALUES[metric] if how == "sum" else MEANS[metric]
    by = "temporada, " + KEY

    @query(name, with_(recent_players("temporada, team"), _ranked(
        _totals(value, "recent", by), k, "temporada, team", "true", by)))
    def run(spark, sf):
        table = pl.totals(recent_rows(spark, sf, ("temporada", "team")), metric, how,
                          ("temporada", *pl.PLAYER))
        return pl.leaders(table, k, ("temporada", "team"))
    return run


_season_leaders("l21_season_minutes", "minutes_played", k=11)
_season_leaders("l21_season_rating_total", "rating")
_season_leaders("l21_season_rating_mean", "rating", "mean")
_season_leaders("l21_season_touches", "touches", "mean")
_season_leaders("l21_season_passes", "total_pass", "mean")
_season_leaders("l21_season_accurate_passes", "accurate_pass", "mean")


@query("l22_squad_age_and_value", with_(recent_players("temporada, team") + """,
squad AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY temporada, team
    ORDER BY minutos DESC, name, player_id, position) rn
  FROM (SELECT temporada, team, player_id, name, position, sum(minutes) AS minutos,
        max(birth) AS birth, max(value) AS value FROM recent GROUP BY ALL)) WHERE rn <= 11),
aged AS (SELECT *, CAST(floor(date_diff('day', CAST(make_timestamp(birth * 1000000) AS DATE),
    DATE '1997-06-15') / 365.25) AS BIGINT) AS idade FROM squad)""", f"""
SELECT temporada, team, {half_up('sum(idade)', 'count(idade)')} AS idade_media,
  {half_up('sum(value)', 'count(value)')} AS valor_medio FROM aged GROUP BY temporada, team"""))
def l22(spark, sf):
    by = ("temporada", "team")
    return pl.squad_age_and_value(recent_rows(spark, sf, by), AS_OF, by=by)


# --- L23 --------------------------------------------------------------------------
@query("l23_goals_by_interval", with_(GOALS, f"""
SELECT clube_gol, inicio, gols, {half_up('gols', 'sum(gols) OVER (PARTITION BY clube_gol)', factor=100)}
  AS perc FROM (SELECT clube_gol, CAST(minutos // 15 * 15 AS INTEGER) AS inicio, count(*) AS gols
  FROM goals WHERE minutos IS NOT NULL GROUP BY ALL)"""))
def l23(spark, sf):
    return pl.goals_by_interval(views.goals(spark, sf))
