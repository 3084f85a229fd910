"""Idempotent loads and exports.

Functions that decide WHAT to store return DataFrames; the few that write use
plain Spark writers, so the row work stays on the cluster.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pitchlake.functions import fixed, text
from pitchlake.operators.club_games import latest_per_key
from pitchlake.session import materialise


def new_rows(
    incoming: DataFrame, stored: DataFrame, key: Sequence[str] = ("id_jogo",)
) -> DataFrame:
    """One incoming row for each key that is not stored yet: that with the fewest NULLs."""
    return one_per_key(incoming, key).join(stored.select(*key), list(key), "left_anti").select(
        incoming.columns)


def fullest_first(columns: Sequence[str]) -> list[Column]:
    """Order of copies of one row: most cells filled first, then by content."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return [filled.desc(), *[F.col(c) for c in columns]]


def one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first under ``order``, then the fullest; the same on every run."""
    rest = [c for c in df.columns if c not in key]
    return latest_per_key(df, key, [*order, *fullest_first(rest)])


def insert_ignore(
    incoming: DataFrame,
    stored: DataFrame,
    key: Sequence[str] = tuple(fixed.HISTORY_KEY),
    order: Sequence[Column] = (),
) -> DataFrame:
    """The first incoming row of each key (under ``order``) that is not stored yet."""
    # Copies are cut to one row before the shuffle, so a heavily repeated key stays cheap.
    return one_per_key(incoming, key, order).join(
        stored.select(*key), list(key), "left_anti").select(incoming.columns)


FILLED = ("pais", "odd_casa", "odd_empate", "odd_fora", "campeonato")
ODDS = ("odd_casa", "odd_empate", "odd_fora")


def is_blank(c: Column, odd: bool = False) -> Column:
    """NULL or empty text; of odds also zero."""
    blank = c.isNull() | (F.trim(c.cast("string")) == "")
    return blank | (c.cast("double") == 0) if odd else blank


def fill_blanks(
    stored: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] = ("id_jogo",),
    columns: Sequence[str] = FILLED,
) -> DataFrame:
    """Stored rows with blank cells filled from incoming ones; nothing else changes.

    Of several incoming values for a cell the smallest fills it. An unknown country and
    odds of zero never do; stored odds of zero are blank.
    """
    new = incoming.groupBy(*key).agg(*[F.min(usable(c)).alias(f"_new_{c}") for c in columns])
    joined = stored.join(new, list(key), "left")
    return joined.select([
        (
            F.when(is_blank(F.col(c), c in ODDS), F.coalesce(f"_new_{c}", c)).otherwise(F.col(c))
            if c in columns
            else F.col(c)
        ).alias(c)
        for c in stored.columns
    ])


def usable(column: str) -> Column:
    """A value that may fill a blank cell, else NULL."""
    value = F.col(column)
    kept = F.when(~is_blank(value, column in ODDS), value)
    if column == "pais":
        return F.when(kept != fixed.UNKNOWN_COUNTRY, kept)
    return kept


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] = ("id_jogo",),
    order: Sequence[Column] = (),
) -> DataFrame:
    """All keys with their newest row: incoming beats stored, then ``order`` decides, then content.

    Only the incoming rows are ranked; stored rows pass an anti join, which is broadcast when
    the delivery is small.
    """
    new = one_per_key(incoming, key, order)
    return stored.join(new.select(*key), list(key), "left_anti").select(stored.columns).unionByName(
        new, allowMissingColumns=True)


def write_changed(
    incoming: DataFrame,
    path: str,
    partition: str,
    key: Sequence[str] = ("id_jogo",),
    change=upsert,
) -> None:
    """Apply ``change(stored, incoming, key)`` to a partitioned Parquet table in place.

    Only the partitions of the incoming rows, and those their keys are stored in now, are read and
    written again, through a copy in the shared folder, so a run that fails before the last
    write leaves the table as it was. A row whose key comes with another partition moves
    there; a partition that loses its last row is removed.
    """
    spark = incoming.sparkSession
    stored = spark.read.schema(incoming.schema).parquet(path)
    own = incoming.select(partition).union(
        stored.join(incoming.select(*key), list(key), "left_semi").select(partition)).distinct()
    touched = [r[0] for r in own.collect()]  # names of partitions
    inside = F.col(partition).isin([t for t in touched if t is not None])
    if None in touched:
        inside = F.col(partition).isNull() | F.coalesce(inside, F.lit(False))
    result = materialise(change(stored.filter(inside), incoming, key), "changed")
    result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition).parquet(path)
    left = {r[0] for r in result.select(partition).distinct().collect()}
    for value in set(touched) - left:
        _drop_partition(spark, path, partition, value)


def _drop_partition(spark, path: str, partition: str, value) -> None:
    """Remove the folders of one value of a partitioned table."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    escaped = "__HIVE_DEFAULT_PARTITION__" if value is None else \
        jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
    fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{partition}={escaped}"), True)


#: Rows of the largest table in a bucket, which one task reads.
BUCKET_ROWS = 1 << 20


def buckets_for(*tables: DataFrame, least: int = 8) -> int:
    """Buckets for tables that are joined on their key: a power of two times ``least`` that grows with the largest.

    Costs a count of each table; what is stored in buckets is read far more often.
    """
    rows, buckets = max(t.count() for t in tables), least
    while buckets * BUCKET_ROWS < rows:
        buckets *= 2
    return buckets


def store_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "id_jogo") -> DataFrame:
    """Write a table hashed and sorted by the match id, and read it back.

    Tables with the same number of buckets join on the id without a shuffle or a sort: matches,
    team and player statistics are stored once like this and joined by every report. Rows are
    dealt by the id before the write, so there is one file for each bucket.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option(
        "path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def align(
    df: DataFrame, schema, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Exactly the schema's columns in its order: missing ones take a default or NULL."""
    defaults = defaults or {}
    return df.select([
        (
            F.col(f.name) if f.name in df.columns else defaults.get(f.name, F.lit(None))
        ).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def append_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Append to a Parquet table and return the rows written, counted during the write.

    Partition match and statistics tables by ``temporada``, so that season scopes
    read only their own files.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("linhas")).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["linhas"]


def insert_new(
    incoming: DataFrame,
    path: str,
    key: Sequence[str] = ("id_jogo",),
    partition_by: Sequence[str] = (),
) -> int:
    """Append the rows whose key the Parquet table does not have; returns how many.

    ``partition_by`` must be the table's own partitioning.
    """
    spark = incoming.sparkSession
    empty = spark.createDataFrame([], incoming.schema).write.mode("ignore")
    (empty.partitionBy(*partition_by) if partition_by else empty).parquet(path)
    stored = spark.read.schema(incoming.schema).parquet(path)
    return append_counted(new_rows(incoming, stored, key), path, partition_by)


def save_reports(reports: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One dataset per report table, replaced when present."""
    for name, table in reports.items():
        writer = table.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(f"{folder.rstrip('/')}/{name}")


def export_goals(goals: DataFrame, path: str) -> None:
    """Goal list in match and minute order as CSV (a range-partitioned sort, many files)."""
    order = [F.col("id_jogo"), F.col("minutos")]
    order += [F.col("ordem")] if "ordem" in goals.columns else []
    goals.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def finite_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinity become NULL in every floating-point column."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: text.finite(F.col(c)) for c in floats}) if floats else df
