"""Match rows -> club-game rows, and the windows built on them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions import labels
from pitchlake.session import materialise

# Total chronological order of one club's games.
CHRONOLOGICAL = ("data", "hora", "id_jogo")


def club_games(matches: DataFrame) -> DataFrame:
    """Two rows per played match, one for each club, in a single pass over the matches."""
    home = F.struct(
        F.col("casa").alias("clube"),
        F.col("fora").alias("adversario"),
        F.lit("Casa").alias("mando"),
        F.col("gols_casa").alias("gols_marcados"),
        F.col("gols_fora").alias("gols_sofridos"),
        F.col("odd_casa").alias("odd"),
    )
    away = F.struct(
        F.col("fora").alias("clube"),
        F.col("casa").alias("adversario"),
        F.lit("Fora").alias("mando"),
        F.col("gols_fora").alias("gols_marcados"),
        F.col("gols_casa").alias("gols_sofridos"),
        F.col("odd_fora").alias("odd"),
    )
    made, conceded = F.col("gols_marcados"), F.col("gols_sofridos")
    return (
        matches.filter(labels.is_played())
        .select(
            "id_jogo", "data", "hora", "temporada", "campeonato", "pais",
            F.explode(F.array(home, away)).alias("lado"),
        )
        .select("id_jogo", "data", "hora", "temporada", "campeonato", "pais", "lado.*")
        .withColumns(
            {
                "venceu": (made > conceded).cast("int"),
                "empatou": (made == conceded).cast("int"),
                "perdeu": (made < conceded).cast("int"),
                "pontos": F.when(made > conceded, 3).when(made == conceded, 1).otherwise(0),
                "total_gols": made + conceded,
            }
        )
    )


def descending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def last_n(
    df: DataFrame,
    n: int = 10,
    by: Sequence[str] = ("clube",),
    order: Sequence[str] = CHRONOLOGICAL,
) -> DataFrame:
    """The n most recent rows of each group.

    ``row_number() <= n`` lets Spark cut every map partition to n rows per group
    before the shuffle, so a club holding most of the rows is still cheap.
    """
    return top_per_group(df, n, by, descending(order))


def last_n_of_wide(
    df: DataFrame,
    n: int = 10,
    by: Sequence[str] = ("clube",),
    order: Sequence[str] = CHRONOLOGICAL,
) -> DataFrame:
    """``last_n`` for wide rows that are unique on (by, id_jogo).

    Only the keys are sorted and shuffled; the short list of recent keys is written
    once and picks the wide rows where they are read.
    """
    keys = last_n(df.select(*dict.fromkeys([*by, *order])), n, by, order).select(*by, "id_jogo")
    return df.join(materialise(keys, "recent-keys"), [*by, "id_jogo"], "left_semi")


def top_per_group(
    df: DataFrame, k: int, by: Sequence[str], order: Sequence[Column], rank: str | None = None
) -> DataFrame:
    """First k rows of each group under a total order, optionally keeping the place."""
    place = rank or "_place"
    w = Window.partitionBy(*by).orderBy(*order)
    cut = df.withColumn(place, F.row_number().over(w)).filter(F.col(place) <= k)
    return cut if rank else cut.drop(place)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first under ``order`` (first-wins or last-wins dedupe)."""
    return top_per_group(df, 1, key, order)


def at_least(df: DataFrame, by: Sequence[str], games: int) -> DataFrame:
    """Rows of the groups with ``games`` rows or more.

    The counts are pre-aggregated and joined back, so no group has to fit in a task.
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= games)
    return df.join(sizes.drop("_n"), list(by), "left_semi")


def last_dates(df: DataFrame, n: int = 10, by: Sequence[str] = ("team",)) -> DataFrame:
    """Rows played on the n most recent dates of each group."""
    days = df.groupBy(*by, "data").agg(F.lit(1).alias("_d")).drop("_d")
    recent = last_n(days, n, by, ("data",))
    return df.join(recent, [*by, "data"], "left_semi")


def rank_all(
    df: DataFrame, lead: str, then: Sequence[Column], rank: str = "posicao"
) -> DataFrame:
    """Position from 1 over the whole table, ordered by ``lead`` descending and then ``then``.

    The table is sorted by ranges, so equal values of ``lead`` are split by the rest of the
    order and no value is one task; a row's place is its place in its range plus the sizes of the
    ranges before. The sorted copy is stored, since both parts must see the same ranges.
    """
    ordered = df.orderBy(F.col(lead).desc(), *then).withColumns(
        {"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}
    )
    ordered = materialise(ordered, "ranked")
    sizes = ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_above"))
    return (
        ordered.join(F.broadcast(sizes), "_range")  # a row for each task of the sort
        .withColumn(rank, (F.col("_above") + F.col("_row") - F.col("_first") + 1).cast("int"))
        .drop("_range", "_row", "_first", "_above")
    )


def best(df: DataFrame, metric: str, k: int, tie: Sequence[str] = ("clube",)) -> DataFrame:
    """Top k of a report table; ties in name order."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *tie).limit(k)


def worst(df: DataFrame, metric: str, k: int, tie: Sequence[str] = ("clube",)) -> DataFrame:
    """Bottom k of a report table, lowest first; ties in name order."""
    return df.orderBy(F.col(metric).asc_nulls_last(), *tie).limit(k)
