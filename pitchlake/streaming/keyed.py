"""Duplicate suppression in keyed state: the first document of a match, whoever delivers it again.

Match ids are dealt by hash into ``SHARDS`` keys of the state store (RocksDB, kept in the checkpoint),
each with the list of its ids, so a batch looks its ids up in state and never reads the log; the
season, or how it is spelt, plays no part. A shard costs one read and at most one write of
state, however many of its ids a batch has. Of several documents of a match in one batch the longest
counts. A loader that starts with a new checkpoint takes the ids of the log as its first state, once.

State grows by one id for each match; a checkpoint of another ``SHARDS`` must be renewed. Two loaders
that run on one log at the same time do not see each other; ``first_rows`` settles that when
the log is read.

Documents are wide, so a load sends only their ids and lengths through state (``first_places``) and
reads the lines it stores from their files again (``lines_at``): a document that was delivered before
is neither shuffled nor sorted, a new one is shuffled once and not sorted.
"""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Keys of state; its layout, so a running checkpoint depends on it.
SHARDS = 1 << 13
SHARD = "_fragmento"
#: Columns of a place: length of the id's longest document, how many rows have it, the marks of their files.
LENGTH, COPIES, FILES = "_tamanho", "_copias", "_arquivos"
#: Places that a task of ``lines_at`` holds, at about a hundred bytes each.
HELD = 250_000


def use_state(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store; queries of the session that start later use it."""
    spark.conf.set(PROVIDER, ROCKSDB)


class FirstDelivery(StatefulProcessor):
    """Passes the rows of an id's first batch on, cut to the longest ``body``; drops later ones.

    Works on the rows of a shard of ids; holds a row for each of its new ids.
    """

    def __init__(self, key: str, kind: T.DataType, body: str):
        self.key, self.kind, self.body = key, kind, body

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("ids", T.ArrayType(self.kind))]))

    def _ids(self) -> list:
        stored = self.seen.get()
        return [] if stored is None else list(stored[0])

    def _before(self, one: Row, other: Row) -> bool:
        a, b = one[self.body], other[self.body]
        return (len(a), str(a)) > (len(b), str(b)) or (a == b and repr(one) > repr(other))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self._ids()
        old, first = set(known), {}
        for r in rows:
            id_ = r[self.key]
            if id_ not in old and (id_ not in first or self._before(r, first[id_])):
                first[id_] = r
        if first:
            self.seen.update((known + list(first),))
        yield from first.values()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((self._ids() + list(initialState["ids"]),))

    def close(self) -> None:
        pass


class FirstPlaces(FirstDelivery):
    """The same state from rows of id, length and file: one row for each new id."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self._ids()
        old, first = set(known), {}
        for r in rows:
            id_, length = r[self.key], r[self.body]
            if id_ in old:
                continue
            most = first.get(id_)
            if most is None or length > most[0]:
                first[id_] = most = [length, 0, set()]
            if length == most[0]:
                most[1] += 1
                most[2].add(r[FILES])
        if first:
            self.seen.update((known + list(first),))
        place = Row(self.key, LENGTH, COPIES, FILES)
        for id_, (length, copies, files) in first.items():
            yield place(id_, length, copies, sorted(files))


def _through_state(rows: DataFrame, key: str, known: DataFrame | None, processor: StatefulProcessor, out: T.StructType) -> DataFrame:
    use_state(rows.sparkSession)
    shard = F.pmod(F.xxhash64(key), F.lit(SHARDS)).alias(SHARD)
    start = None if known is None else known.select(key).distinct().groupBy(shard).agg(F.collect_list(key).alias("ids")).groupBy(SHARD)
    return rows.select("*", shard).groupBy(SHARD).transformWithState(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="None", initialState=start)


def first_deliveries(rows: DataFrame, key: str, body: str, known: DataFrame | None = None) -> DataFrame:
    """The first row of each key of a stream; keys in ``known`` count as delivered.

    ``known`` is read when the checkpoint is new, and by no later batch. Whole rows are shuffled and
    sorted; for wide ones take ``first_places``.
    """
    return _through_state(rows, key, known, FirstDelivery(key, rows.schema[key].dataType, body), rows.schema)


def first_places(rows: DataFrame, key: str, body: str, file: Column, known: DataFrame | None = None) -> DataFrame:
    """Where ``first_deliveries`` finds its rows: key, length of ``body``, number of rows that have it, marks of their files.

    ``file`` marks the file of a row (a BIGINT), the same way for ``lines_at``.
    """
    kind = rows.schema[key].dataType
    narrow = rows.select(key, F.length(body).alias(LENGTH), file.alias(FILES))
    out = T.StructType([T.StructField(key, kind), T.StructField(LENGTH, T.IntegerType()), T.StructField(COPIES, T.LongType()),
                        T.StructField(FILES, T.ArrayType(T.LongType()))])
    return _through_state(narrow, key, known, FirstPlaces(key, kind, LENGTH), out)


def lines_at(lines: DataFrame, places: DataFrame, key: str, body: str, file: Column) -> DataFrame:
    """The rows that ``first_deliveries`` gives, read again from the files of ``places``.

    ``places`` is read several times, so it should be persisted. Rows are dealt by id and meet a hash table
    of places; only where an id has several longest rows are these sorted, to take the one that
    ``FirstDelivery`` takes.
    """
    marks = [r[0] for r in places.select(F.explode(FILES)).distinct().collect()]
    count, most = places.agg(F.count(F.lit(1)), F.max(COPIES)).first()
    tasks = max(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), count // HELD + 1)
    found = (lines.filter(file.isin(marks)) if marks else lines.filter(F.lit(False))).repartition(tasks, key)

    def met(some: Column) -> DataFrame:
        table = places.filter(some).select(key, LENGTH).repartition(tasks, key).hint("shuffle_hash")
        # No row is longer than its place says; an equality would become a second key to deal by.
        return found.join(table, key).filter(F.length(body) >= F.col(LENGTH)).select(lines.columns)

    single = met(F.col(COPIES) == 1)
    if most is None or most == 1:
        return single
    said = F.udf(repr, "string")(F.struct(*[c for c in lines.columns if c != body]))
    tied = met(F.col(COPIES) > 1).withColumn("_dito", said).groupBy(key).agg(
        F.max_by(F.struct(*lines.columns), F.struct(body, "_dito")).alias("_linha")).select("_linha.*")
    return single.unionByName(tied)


def first_rows(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of the delivery that came first for each key, where loaders overlapped."""
    place = F.struct(*order)
    first = log.groupBy(key).agg(F.min(place).alias("_first"))
    return log.join(first, key).filter(place == F.col("_first")).select(log.columns)
