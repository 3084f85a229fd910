"""Incremental loads: landing files -> append-only logs -> current tables.

A log is a folder of ``ordem=N/carga=ID/batch_id=N/temporada=S``. ``carga`` is the identity of a
load, kept in its checkpoint: two loaders, or one whose checkpoint was renewed, never write
to the same folder, and a replayed batch replaces its own. ``ordem`` counts the batches of all
loads, so "first" means the same whoever delivered. A stored match is never rewritten: later
rows only fill its blanks, which is resolved when the log is read. Lines that cannot be read
go to a log of rejected lines beside it.
"""

import gc
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitchlake import schemas
from pitchlake.operators import sinks
from pitchlake.sources import documents
from pitchlake.streaming import keyed

SEASON = "temporada"
FOLDERS = ("ordem", "carga", "batch_id")
COLUMNS = [f.name for f in schemas.MATCHES.fields]
BROKEN = "_linha"
#: Seasons that a task of a document load writes side by side, without a sort of its rows, and the bytes it holds of each.
SEASONS_OPEN, ROW_GROUP = 8, 32 << 20
STATISTICS = T.StructType([
    *[f for f in schemas.TEAM_STATS.fields if f.name in ("id_jogo", "periodo", "clube", SEASON)],
    T.StructField("metricas", T.MapType(T.StringType(), T.StringType())),
])


def rejected_dir(log_dir: str) -> str:
    return f"{log_dir.rstrip('/')}_rejeitados"


def create_log(spark: SparkSession, log_dir: str, schema: T.StructType = schemas.MATCHES) -> None:
    """Make the log readable before its first batch; does nothing when it exists."""
    empty = spark.createDataFrame([], T.StructType([f for f in schema.fields if f.name != SEASON]))
    empty.write.mode("ignore").parquet(f"{log_dir}/ordem=-1/carga=inicio/batch_id=-1/{SEASON}=-")


def read_log(spark: SparkSession, log_dir: str, schema: T.StructType = schemas.MATCHES) -> DataFrame:
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if f.name != SEASON)
    return spark.read.schema(
        f"{ddl}, ordem BIGINT, carga STRING, batch_id BIGINT, {SEASON} STRING").parquet(log_dir)


def _order() -> Column:
    return F.struct(*FOLDERS)


def _folder(log: DataFrame, log_dir: str, carga: str, batch_id: int) -> str:
    """The batch's own folder if it was written before, else the next in order."""
    mine = (F.col("carga") == carga) & (F.col("batch_id") == batch_id)
    own, last = log.agg(F.min(F.when(mine, F.col("ordem"))), F.max("ordem")).first()
    order = own if own is not None else (last if last is not None else -1) + 1
    return f"{log_dir}/ordem={order}/carga={carga}/batch_id={batch_id}"


def _nonblank(c, name: str) -> Column:
    return F.when(~sinks.is_blank(c, name in sinks.ODDS), c)


def current_matches(log: DataFrame) -> DataFrame:
    """One row per match: the first batch's row, blanks filled by the earliest later batch.

    Rows go to their match before they are sorted, once: most matches have one row, so nothing is
    gained by merging, which sorts whole rows, before the shuffle too.
    """
    return _resolved(log.repartition("id_jogo"))


def _resolved(log: DataFrame) -> DataFrame:
    """``current_matches`` of rows as they are dealt."""
    own = [c for c in COLUMNS if c != "id_jogo"]
    rows = log.groupBy("id_jogo").agg(
        F.min_by(F.struct(*own), _order()).alias("_first"),
        *[
            F.min_by(sinks.usable(c), F.when(sinks.usable(c).isNotNull(), _order())).alias(c)
            for c in sinks.FILLED
        ],
    )
    first = F.col("_first")
    return rows.select([
        F.coalesce(_nonblank(first[c], c), F.col(c)).alias(c)
        if c in sinks.FILLED
        else (F.col(c) if c == "id_jogo" else first[c].alias(c))
        for c in COLUMNS
    ])


def merge_batch(batch: DataFrame) -> DataFrame:
    """One row per match of a micro-batch: the copy with most cells filled, its blanks
    filled from the others. Copies meet before they are sorted, once, and are merged as they stream by."""
    keep = [c for c in COLUMNS if c not in (*sinks.FILLED, "id_jogo")]
    empty = sum((F.col(c).isNull().cast("int") for c in keep), F.lit(0))
    rows = batch.repartition("id_jogo").groupBy("id_jogo").agg(
        F.min(F.struct(empty.alias("_empty"), *keep)).alias("_row"),
        *[
            F.coalesce(F.min(sinks.usable(c)), F.min(_nonblank(F.col(c), c))).alias(c)
            for c in sinks.FILLED
        ],
    )
    return rows.select("id_jogo", "_row.*", *sinks.FILLED).select(*COLUMNS)


def useful_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of new matches, and rows that fill a blank of a stored one."""
    fills = F.lit(False)
    for c in sinks.FILLED:
        blank = sinks.is_blank(F.col(f"_s_{c}"), c in sinks.ODDS)
        fills = fills | (blank & sinks.usable(c).isNotNull())
    known = stored.select(
        "id_jogo", F.lit(True).alias("_known"), *[F.col(c).alias(f"_s_{c}") for c in sinks.FILLED]
    )
    joined = batch.join(known, "id_jogo", "left")
    return joined.filter(F.col("_known").isNull() | fills).select(*COLUMNS)


def _of_seasons(log: DataFrame, batch: DataFrame) -> DataFrame:
    """The log's folders of the seasons that a batch has (and of no season)."""
    seasons = [r[0] for r in batch.select(SEASON).distinct().collect() if r[0] is not None]
    return log.filter(F.col(SEASON).isNull() | F.col(SEASON).isin(seasons))


def _reject(batch: DataFrame, bad: Column, folder: str) -> None:
    """Write the lines without a match id to the rejected log."""
    line = F.col(BROKEN) if BROKEN in batch.columns else F.to_json(F.struct(*batch.columns))
    batch.filter(bad).select(line.alias("linha")).write.mode("overwrite").parquet(folder)


def store_batch(batch: DataFrame, batch_id: int, log_dir: str, carga: str = "manual") -> None:
    """Write one micro-batch of matches; running it again gives the same log.

    Bad lines are counted as the batch is merged, so it is parsed a second time only where it has some.
    """
    spark = batch.sparkSession
    bad, seen = F.col("id_jogo").isNull(), Observation()
    good = batch.observe(seen, F.count(F.when(bad, 1)).alias("ruins")).filter(~bad)
    unique = merge_batch(sinks.align(good, schemas.MATCHES)).persist()
    try:
        log = read_log(spark, log_dir)
        folder = _folder(log, log_dir, carga, batch_id)
        # Only the matches of this batch, in the folders of its seasons, are looked up.
        others = _of_seasons(log, unique).filter((F.col("carga") != carga) | (F.col("batch_id") != batch_id))
        _reject(batch if seen.get["ruins"] else batch.limit(0), bad, f"{rejected_dir(log_dir)}/carga={carga}/batch_id={batch_id}")
        stored = _resolved(others.join(unique.select("id_jogo"), "id_jogo", "left_semi"))
        useful_rows(unique, stored).write.mode("overwrite").partitionBy(SEASON).parquet(folder)
    finally:
        unique.unpersist()


def store_first(
    batch: DataFrame, batch_id: int, log_dir: str, carga: str, schema: T.StructType,
    flatten: Callable[[DataFrame], DataFrame],
) -> None:
    """Write the rows of documents that keyed state let through; the log is not read."""
    folder = f"{log_dir}/ordem={batch_id}/carga={carga}/batch_id={batch_id}"
    rows = sinks.align(flatten(batch), schema).write.mode("overwrite").partitionBy(SEASON)
    rows.option("parquet.block.size", ROW_GROUP).parquet(folder)


def compact_log(spark: SparkSession, log_dir: str, to: str, schema: T.StructType = schemas.MATCHES) -> None:
    """Copy a log into one batch at ``to``; run it now and then and let the loaders go on there."""
    rows = read_log(spark, log_dir, schema)
    whole = current_matches(rows) if schema is schemas.MATCHES else rows.select([f.name for f in schema.fields])
    create_log(spark, to, schema)
    whole.write.mode("overwrite").partitionBy(SEASON).parquet(f"{to}/ordem=0/carga=compacta/batch_id=0")


def load_events(
    spark: SparkSession,
    landing: str,
    log_dir: str,
    checkpoint: str,
    club_names: DataFrame | None = None,
    competitions: DataFrame | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start loading all landed event files (JSON lines) and stop when none is left.

    A line is ``{"evento": {...}, "pais", "temporada", "odd_casa", "odd_empate", "odd_fora"}``.
    """
    create_log(spark, log_dir)
    docs = _json(spark, landing, files_per_batch,
                 "evento STRING, pais STRING, temporada STRING, odd_casa DECIMAL(8,2), "
                 "odd_empate DECIMAL(8,2), odd_fora DECIMAL(8,2)", "evento").withColumnRenamed("evento", "doc")
    rows = documents.flatten_events(docs, club_names, competitions).withColumn(
        "cadastrado_em", F.current_timestamp()
    )
    return _start(rows, checkpoint, lambda df, i, carga: store_batch(df, i, log_dir, carga))


def load_match_csv(
    spark: SparkSession, landing: str, log_dir: str, checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """The same load from comma CSV files that already have the matches contract."""
    create_log(spark, log_dir)
    schema = T.StructType([*schemas.MATCHES.fields, T.StructField(BROKEN, T.StringType())])
    reader = spark.readStream.schema(schema).option("header", True).option("columnNameOfCorruptRecord", BROKEN)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(landing)
    rows = rows.withColumn(BROKEN, F.coalesce(BROKEN, F.to_csv(F.struct(*COLUMNS))))
    return _start(rows, checkpoint, lambda df, i, carga: store_batch(df, i, log_dir, carga))


def _load_documents(spark, landing, log_dir, checkpoint, files_per_batch, schema, flatten) -> StreamingQuery:
    """Documents of matches that the log does not have: the rest of a line never decides that.

    The stream carries ids and lengths; a batch reads the lines it stores from their files again.
    """
    create_log(spark, log_dir, schema)
    ddl = "id_jogo BIGINT, casa STRING, fora STRING, temporada STRING, campeonato STRING, doc STRING"
    lines = _json(spark, landing, files_per_batch, ddl, "doc")
    bad, file = F.col("id_jogo").isNull() | F.col("doc").isNull(), F.xxhash64("_metadata.file_path")
    known = read_log(spark, log_dir, schema).filter(F.col("id_jogo").isNotNull())
    first = keyed.first_places(lines.filter(~bad), "id_jogo", "doc", file, known)

    def store(places: DataFrame, batch_id: int, carga: str) -> None:
        places.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", SEASONS_OPEN)  # the stream's own session
        places.persist()
        try:
            landed = _reader(places.sparkSession.read, ddl).json(landing).filter(~bad).drop(BROKEN)
            store_first(keyed.lines_at(landed, places, "id_jogo", "doc", file),
                        batch_id, log_dir, carga, schema, flatten)
        finally:
            places.unpersist()
        gc.collect()  # the driver's garbage holds the shuffle files of what is stored now
        spark._jvm.System.gc()

    rejected = _start(
        lines.filter(bad).select(F.coalesce(BROKEN, F.to_json(F.struct(*lines.drop(BROKEN).columns))).alias("linha")), f"{checkpoint.rstrip('/')}/rejeitados",
        lambda df, i, carga: df.write.mode("overwrite").parquet(f"{rejected_dir(log_dir)}/carga={carga}/batch_id={i}"))
    rejected.awaitTermination()
    return _start(first, f"{checkpoint.rstrip('/')}/linhas", store)


def load_statistics(spark: SparkSession, landing: str, log_dir: str, checkpoint: str,
                    files_per_batch: int | None = None) -> StreamingQuery:
    """Team statistics of matches that have none yet, as rows with a metric map.

    A line of this and the next loads is ``{"id_jogo", "casa", "fora", "temporada", "campeonato", "doc"}``.
    """
    return _load_documents(spark, landing, log_dir, checkpoint, files_per_batch, STATISTICS,
                           documents.flatten_team_stats)


def load_lineups(spark: SparkSession, landing: str, log_dir: str, checkpoint: str,
                 files_per_batch: int | None = None) -> StreamingQuery:
    """Players of matches that have none yet."""
    return _load_documents(
        spark, landing, log_dir, checkpoint, files_per_batch, schemas.PLAYER_STATS,
        lambda d: documents.widen(documents.flatten_lineups(d), schemas.PLAYER_STATS))


def load_goals(spark: SparkSession, landing: str, log_dir: str, checkpoint: str,
               files_per_batch: int | None = None) -> StreamingQuery:
    """Goals of matches that have none yet."""
    return _load_documents(
        spark, landing, log_dir, checkpoint, files_per_batch, schemas.GOALS,
        lambda d: documents.flatten_goals(d).withColumn("cadastrado_em", F.current_timestamp()))


def _json(spark, landing: str, files_per_batch: int | None, ddl: str, body: str) -> DataFrame:
    """Landed JSON lines with the raw line, or the body where the line is whole, in ``_linha``."""
    reader = _reader(spark.readStream, ddl)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(landing).withColumn(BROKEN, F.coalesce(BROKEN, body))


def _reader(reader, ddl: str):
    return reader.schema(f"{ddl}, {BROKEN} STRING").option("columnNameOfCorruptRecord", BROKEN)


def _start(rows: DataFrame, checkpoint: str, store: Callable[[DataFrame, int, str], None]) -> StreamingQuery:
    def identity() -> str:
        """The id that Spark gives a checkpoint and keeps in it."""
        return json.loads(rows.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]

    return (
        rows.writeStream.foreachBatch(lambda df, i: store(df, i, identity()))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
