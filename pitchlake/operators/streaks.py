"""Longest and current runs of games with a property (unbeaten, winning, ...)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.operators.club_games import CHRONOLOGICAL

UNBEATEN = "invicto"
WINNING = "vitoria"


def holds(kind: str) -> Column:
    if kind == UNBEATEN:
        return F.col("gols_marcados") >= F.col("gols_sofridos")
    if kind == WINNING:
        return F.col("gols_marcados") > F.col("gols_sofridos")
    raise ValueError(f"unknown run: {kind}")


def runs(
    games: DataFrame,
    kind: str = UNBEATEN,
    by: Sequence[str] = ("clube",),
    block: Sequence[str] = ("mes",),
) -> DataFrame:
    """Per group: ``maior`` (longest run) and ``atual`` (run still going).

    A club's timeline is cut into blocks that respect its order (calendar months; or
    other columns of ``games``). Each block is summarised on its own, so one club's games
    spread over many tasks; the second window has one row for each of a club's months.
    """
    by, block = list(by), list(block)
    if block == ["mes"]:
        games = games.withColumn("mes", F.trunc("data", "month"))
    inside = [c for c in CHRONOLOGICAL if c not in block]
    ok = F.when(holds(kind), 1).otherwise(0)

    in_block = Window.partitionBy(*by, *block).orderBy(*inside).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    pieces = (
        games.select(*by, *block, *inside, ok.alias("_ok"))
        .withColumn("_break", F.sum(1 - F.col("_ok")).over(in_block))
        .groupBy(*by, *block, "_break")
        .agg(F.sum("_ok").alias("_len"))
    )
    blocks = pieces.groupBy(*by, *block).agg(
        F.max("_break").alias("_breaks"),
        F.max("_len").alias("_longest"),
        F.coalesce(F.max(F.when(F.col("_break") == 0, F.col("_len"))), F.lit(0)).alias("_head"),
        F.max_by("_len", "_break").alias("_tail"),
    )

    # A run that crosses blocks is the tail of a broken block, whole unbroken
    # blocks, and the head of the next broken one: sum them per island.
    across = Window.partitionBy(*by).orderBy(*block).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    broken = F.col("_breaks") > 0
    island = F.sum(F.when(broken, 1).otherwise(0)).over(across)
    joined = blocks.withColumn("_island", island).select(
        *by,
        "_longest",
        F.explode(
            F.when(
                broken,
                F.array(
                    F.struct((F.col("_island") - 1).alias("i"), F.col("_head").alias("n")),
                    F.struct(F.col("_island").alias("i"), F.col("_tail").alias("n")),
                ),
            ).otherwise(F.array(F.struct(F.col("_island").alias("i"), F.col("_head").alias("n"))))
        ).alias("_p"),
    )
    islands = joined.groupBy(*by, F.col("_p.i").alias("_i")).agg(
        F.sum("_p.n").alias("_n"), F.max("_longest").alias("_longest")
    )
    return islands.groupBy(*by).agg(
        F.greatest(F.max("_n"), F.max("_longest")).alias("maior"),
        F.max_by("_n", "_i").alias("atual"),
    )
