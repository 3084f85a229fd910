"""Windows and runs that a delivery of matches updates without reading all history.

**Recent games.** The state has a row for each group (a club, a club's season): the last
``n + reserve`` games, newest first, and the order of the newest game ever dropped from it
(``piso``). All games above that order are in the state, so its first ``n`` are exact as long as
that many lie above it. A delivery drops every stored version of its matches, adds the new
ones and cuts again; a late game above ``piso`` finds its place, one below it changes nothing. Only
corrections that take away more games than the reserve holds leave a group short; such groups say
so (``completo``) and ``refilled`` reads their history alone.

**Runs.** A block (a club's month) is summarised as (length, run at its start, run at its end,
longest run). Two neighbours merge into the same four numbers, whatever lies between was merged
before, so the summaries of any cut of the timeline give the runs of the whole. A delivery,
late or corrected, recomputes the blocks it touches, old and new place of a game, and
only their games are read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.operators import sinks
from pitchlake.operators.club_games import CHRONOLOGICAL, club_games, descending, top_per_group
from pitchlake.operators.streaks import UNBEATEN, holds

N, RESERVE = 10, 10


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in CHRONOLOGICAL])


def one_version(delivery: DataFrame) -> DataFrame:
    """One row for each match of a delivery: the fullest."""
    return sinks.one_per_key(delivery, ["id_jogo"])


# --- recent games ------------------------------------------------------------------------
def _cut(games: DataFrame, floors: DataFrame | None, by: Sequence[str], n: int, reserve: int) -> DataFrame:
    """State rows of the groups in ``games`` and ``floors``; games may be any number for each group."""
    keep = n + reserve
    own = [c for c in games.columns if c not in by]
    # Each task cuts its rows before the shuffle; the row after the last kept gives the floor.
    top = top_per_group(games, keep + 1, by, descending(CHRONOLOGICAL), "_n")
    rows = top.groupBy(*by).agg(
        F.collect_list(F.when(F.col("_n") <= keep, F.struct(_place().alias("ordem"), *own))).alias("_jogos"),
        F.max(F.when(F.col("_n") > keep, _place())).alias("_piso"))
    if floors is None:
        rows = rows.withColumn("piso", F.col("_piso"))
    else:
        rows = rows.join(floors, list(by), "full").withColumn("piso", F.greatest("_piso", "piso"))
    jogos = F.filter(F.reverse(F.array_sort(F.coalesce("_jogos", F.array()))),
                     lambda g: F.col("piso").isNull() | (g["ordem"] > F.col("piso")))
    rows = rows.withColumn("jogos", jogos)
    return rows.select(*by, "jogos", "piso", (F.col("piso").isNull() | (F.size("jogos") >= n)).alias("completo"))


def recent_state(matches: DataFrame, by: Sequence[str] = ("clube",), n: int = N, reserve: int = RESERVE) -> DataFrame:
    """(by, jogos, piso, completo) of all matches at once."""
    return _cut(club_games(one_version(matches)), None, list(by), n, reserve)


def updated(state: DataFrame, delivery: DataFrame, by: Sequence[str] = ("clube",), n: int = N,
            reserve: int = RESERVE) -> DataFrame:
    """The state after a delivery of new, late and corrected matches.

    Reads the state and the delivery only. A match replaces its stored version, also
    where its clubs, its date or its season changed or its score was taken back.
    """
    by = list(by)
    new = one_version(delivery)
    held = state.select(*by, F.explode("jogos").alias("j")).select(*by, "j.*").drop("ordem")
    kept = held.join(new.select("id_jogo"), "id_jogo", "left_anti").select(held.columns)
    games = kept.unionByName(club_games(new).select(held.columns))
    return _cut(games, state.select(*by, "piso"), by, n, reserve)


def refilled(state: DataFrame, matches: DataFrame, by: Sequence[str] = ("clube",), n: int = N,
             reserve: int = RESERVE) -> DataFrame:
    """The state with its short groups computed again from their history; others are passed on."""
    by = list(by)
    short = state.filter(~F.col("completo")).select(*by)
    again = _cut(club_games(one_version(matches)).join(short, by, "left_semi"), None, by, n, reserve)
    gone = short.join(again.select(*by), by, "left_anti").join(state, by).select(state.columns)
    none = gone.withColumns({"jogos": F.slice("jogos", 1, 0), "completo": F.lit(True),
                             "piso": F.lit(None).cast(state.schema["piso"].dataType)})
    return state.filter("completo").unionByName(again).unionByName(none)


def recent_games(state: DataFrame, by: Sequence[str] = ("clube",), n: int = N) -> DataFrame:
    """The last n games of each group as ``club_games`` rows, for the same cards."""
    return state.select(*by, F.explode(F.slice("jogos", 1, n)).alias("j")).select(*by, "j.*").drop("ordem")


# --- runs --------------------------------------------------------------------------------
BLOCK = "mes"


def _month() -> Column:
    """Month of a game; games without a date are one block before all others, as they sort."""
    return F.coalesce(F.trunc("data", "month"), F.lit("0001-01-01").cast("date"))


def with_month(games: DataFrame) -> DataFrame:
    return games.withColumn(BLOCK, _month())


def blocks(games: DataFrame, kind: str = UNBEATEN, by: Sequence[str] = ("clube",)) -> DataFrame:
    """(by, mes, comprimento, inicio, fim, maior) of each block of ``club_games`` rows."""
    by = [*by, BLOCK]
    inside = Window.partitionBy(*by).orderBy(*CHRONOLOGICAL).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ok = F.when(holds(kind), 1).otherwise(0)
    islands = (
        with_month(games).select(*by, *[c for c in CHRONOLOGICAL if c not in by], ok.alias("_ok"))
        .withColumn("_break", F.sum(1 - F.col("_ok")).over(inside))
        .groupBy(*by, "_break").agg(F.sum("_ok").alias("_run"), F.count(F.lit(1)).alias("_games"))
    )
    return islands.groupBy(*by).agg(
        F.sum("_games").alias("comprimento"),
        F.coalesce(F.max(F.when(F.col("_break") == 0, F.col("_run"))), F.lit(0)).cast("bigint").alias("inicio"),
        F.max_by("_run", "_break").alias("fim"), F.max("_run").alias("maior"))


def touched(blocks_of: DataFrame, before: DataFrame, delivery: DataFrame, by: Sequence[str] = ("clube",)) -> DataFrame:
    """Blocks that a delivery changes: those its matches were in and those they go to.

    ``before`` has the stored versions of the delivered matches.
    """
    keys = [*by, BLOCK]
    places = with_month(club_games(one_version(delivery))).select(*keys).unionByName(
        with_month(club_games(before)).select(*keys))
    return places.distinct()


def update_blocks(state: DataFrame, stored: DataFrame, delivery: DataFrame, kind: str = UNBEATEN,
                  by: Sequence[str] = ("clube",)) -> DataFrame:
    """Block summaries after a delivery; ``stored`` has the matches before it, one row each.

    Of the stored matches only the delivered ones and those of touched blocks are used: both
    are semi joins with short lists, on the match id and on the months.
    """
    keys = [*by, BLOCK]
    new = one_version(delivery)
    ids = new.select("id_jogo")
    before = stored.join(ids, "id_jogo", "left_semi")
    hit = touched(state, before, new, by)
    months = hit.select(BLOCK).distinct()
    around = with_month(stored).join(months, BLOCK, "left_semi").drop(BLOCK)
    kept = around.join(ids, "id_jogo", "left_anti").select(new.columns)
    games = with_month(club_games(kept.unionByName(new))).join(hit, keys, "left_semi")
    return state.join(hit, keys, "left_anti").select(state.columns).unionByName(blocks(games, kind, by))


def _merged(left: Column, right: Column) -> Column:
    """Summary of two neighbouring stretches of games."""
    whole = lambda s: s["inicio"] == s["comprimento"]
    return F.struct(
        (left["comprimento"] + right["comprimento"]).alias("comprimento"),
        F.when(whole(left), left["comprimento"] + right["inicio"]).otherwise(left["inicio"]).alias("inicio"),
        F.when(whole(right), left["fim"] + right["comprimento"]).otherwise(right["fim"]).alias("fim"),
        F.greatest(left["maior"], right["maior"], left["fim"] + right["inicio"]).alias("maior"))


def merged(summaries: DataFrame, by: Sequence[str] = ("clube",), order: str = BLOCK) -> DataFrame:
    """One summary for each group from those of its blocks, in their order.

    The result has the same four numbers, so it can be merged with its neighbours again. A
    group's summaries meet in one row: a few numbers for each month.
    """
    parts = ["comprimento", "inicio", "fim", "maior"]
    none = F.struct(*[F.lit(0).cast("bigint").alias(p) for p in parts])
    seen = F.transform(F.array_sort(F.collect_list(F.struct(order, *parts))), lambda s: F.struct(*[s[p].alias(p) for p in parts]))
    rows = summaries.groupBy(*by).agg(F.min(order).alias(order), seen.alias("_s"))
    return rows.withColumn("_s", F.aggregate("_s", none, _merged)).select(*by, order, "_s.*")


def runs(summaries: DataFrame, by: Sequence[str] = ("clube",)) -> DataFrame:
    """``maior`` and ``atual`` of each group, as ``streaks.runs`` gives them."""
    return merged(summaries, by).select(*by, "maior", F.col("fim").alias("atual"))
