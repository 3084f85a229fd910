"""Registered queries over windows and runs that deliveries update, against the whole recomputation."""

from pyspark.sql import functions as F

from pitchlake.operators import maintained, results, sinks, streaks
from pitchlake.session import materialise
from verification import views
from verification.oracle_views import GAMES
from verification.queries_results import LAST_SEASON_GAMES, SEASON_KEY, _card_sql, _runs_sql
from verification.registry import query, with_


def deliveries(spark, sf):
    """Three deliveries in no order of time: wrong scores and dates at first, overlaps, late
    games, and corrections at the end; the last version of every match is that of the view."""
    m = views.matches(spark, sf).drop("_cents")
    k = F.col("id_jogo")
    wrong = (k % 9 == 0) | (k % 14 == 0)
    early = (F.col("data") < "1997-01-01") & (k % 6 != 0)
    middle = (F.col("data") >= "1996-06-01") & (F.col("data") < "1998-07-01") & (k % 6 != 0)
    bad = m.filter(early).withColumns({
        "gols_casa": F.when(k % 9 == 0, F.col("gols_casa") + 1).otherwise(F.col("gols_casa")),
        "gols_fora": F.when(k % 27 == 0, None).otherwise(F.col("gols_fora")),
        "data": F.when(k % 14 == 0, F.date_add("data", 40)).otherwise(F.col("data")),
        "casa": F.when(k % 63 == 0, F.col("fora")).otherwise(F.col("casa")),
        "fora": F.when(k % 63 == 0, F.col("casa")).otherwise(F.col("fora")),
    })
    last = (~early & ~middle) | wrong | (k % 6 == 0)
    return [bad, m.filter(middle & ~wrong), m.filter(last)], m


def _state(spark, sf, by, n=10, reserve=10):
    parts, every = deliveries(spark, sf)
    state = materialise(maintained.recent_state(parts[0], by, n, reserve), "recent")
    for part in parts[1:]:
        state = materialise(maintained.updated(state, part, by, n, reserve), "recent")
    return maintained.refilled(state, every, by, n, reserve)


@query("w10_maintained_last_10_games", with_(GAMES, """
SELECT clube, id_jogo, CAST(data AS VARCHAR) AS data, gm AS gols_marcados FROM (
  SELECT *, row_number() OVER (PARTITION BY clube ORDER BY data DESC, hora DESC, id_jogo DESC) rn
  FROM games) WHERE rn <= 10"""))
def w10(spark, sf):
    return maintained.recent_games(_state(spark, sf, ("clube",))).select(
        "clube", "id_jogo", F.col("data").cast("string").alias("data"), "gols_marcados")


@query("w10_maintained_last_10_card", with_(LAST_SEASON_GAMES, _card_sql("recent", "temporada, clube")))
def w10_card(spark, sf):
    return results.season_card(maintained.recent_games(_state(spark, sf, SEASON_KEY), SEASON_KEY), SEASON_KEY)


def _blocks(spark, sf, kind, by):
    parts, _ = deliveries(spark, sf)
    stored = materialise(parts[0], "stored")
    state = materialise(maintained.blocks(maintained.club_games(maintained.one_version(stored)), kind, by), "blocks")
    for part in parts[1:]:
        state = materialise(maintained.update_blocks(state, stored, part, kind, by), "blocks")
        stored = materialise(sinks.upsert(stored, part), "stored")
    return state


@query("w11_maintained_unbeaten_runs", _runs_sql("gm >= gs", "clube"))
def w11(spark, sf):
    return maintained.runs(_blocks(spark, sf, streaks.UNBEATEN, ("clube",)))


@query("w11_maintained_winning_runs_by_season", _runs_sql("gm > gs", "temporada, clube"))
def w11_season(spark, sf):
    return maintained.runs(_blocks(spark, sf, streaks.WINNING, SEASON_KEY), SEASON_KEY)
