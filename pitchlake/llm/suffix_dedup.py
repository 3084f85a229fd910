"""Repeated byte windows: a depth-limited radix sort of suffixes, spread over the cluster.

Two windows of ``WINDOW`` bytes are equal if the suffixes that start there agree through
``WINDOW`` bytes; nothing behind that depth is ever looked at. The most significant digit of a
suffix is its anchor, the smallest hash among the runs of ``ANCHOR`` bytes in its window (the
leftmost of equals): equal windows have equal anchors at equal places. All neighbouring windows
of one anchor travel as one segment, so that about one entry for each sixteen bytes is dealt out
by that digit. Segments that are equal as a whole need no further digit: all but those of the
smallest document are removed. Where an anchor has segments that differ, the windows of what is
left take the next passes one by one: each task orders them by eight bytes at a time, going on
only within groups that are still equal, and the distinct ones meet by their digest. Groups
that are equal to the full depth are exactly the repeated windows.

Within a task only the smallest document of equal segments is sent on, so that however often a
passage is repeated, a bucket gets it once from each task's batch. Digests have 64 bits.

Defined results: a null or empty text has no byte and nothing to remove; a window counts as
repeated only if it starts in a document with a smaller id, so repeats within a document and
rows that repeat an id stay; a null id neither removes nor is removed from. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import arrays
from pitchlake.llm.common import release, stored

WINDOW, ANCHOR = 50, 20
#: Bytes of text whose hashes are made at once, and whose entries are sent together.
PIECE, SEND = 1 << 20, 1 << 23
#: Least number of buckets, and entries that a bucket is made for.
BUCKETS, ENTRIES = 128, 1_000_000
_PLACE = np.uint64((1 << 21) - 1)


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of whole texts or, of a long one, of parts that overlap by a window less a byte."""
    at, n = 0, int(offsets[-1])
    while at < n:
        to = min(at + PIECE, n)
        stop = to
        if to < n:
            whole = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if whole > at:
                to = stop = whole
            else:
                stop = min(to + WINDOW - 1, int(offsets[np.searchsorted(offsets, at, "right")]))
        yield at, stop
        at = to


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first start, end, anchor digest, segment digest); places are bytes from the row's start."""
    out = []
    for lo, hi in pieces(offsets):
        n = hi - lo - WINDOW + 1
        if n < 1:
            continue
        part = data[lo:hi]
        runs = np.arange(hi - lo - ANCHOR + 1)
        h = arrays.span_hashes(part, runs, runs + ANCHOR)
        least = (h & ~_PLACE) | runs.astype(np.uint64)
        width = WINDOW - ANCHOR + 1
        size = 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[:n], least[width - size:width - size + n])
        place = (least & _PLACE).astype(np.int64)
        row = np.searchsorted(offsets, np.arange(lo, lo + n), "right") - 1
        valid = np.arange(lo, lo + n) + WINDOW <= offsets[row + 1]
        cut = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(row) != 0) | (np.diff(valid.view(np.int8)) != 0)])
        first = np.flatnonzero(cut)
        last = np.concatenate([first[1:], [n]]) - 1
        first, last = first[valid[first]], last[valid[first]]
        end = last + WINDOW
        with np.errstate(over="ignore"):
            whole = arrays.mix(arrays.span_hashes(part, first, end)
                               + (place[first] - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        base = lo - offsets[row[first]]
        out.append((row[first], first + base, end + base, h[place[first]], whole))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(c) for c in zip(*out))


def radix_groups(data: np.ndarray, starts: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """Group number of each window, by passes over eight bytes, most significant first.

    A window that is alone in its group takes no further pass.
    """
    group = np.zeros(len(starts), np.int64)
    if not len(starts):
        return group
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    live = np.arange(len(starts))
    for at in range(0, depth, 8):
        take = min(8, depth - at)
        digit = np.zeros(len(live), np.uint64)
        for k in range(take):
            digit = (digit << np.uint64(8)) | padded[starts[live] + at + k]
        order = np.lexsort((digit, group[live]))
        g, d = group[live][order], digit[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
        number = np.cumsum(new) - 1 + group.max() + 1
        group[live[order]] = number
        count = np.diff(np.concatenate([np.flatnonzero(new), [len(new)]]))
        many = np.repeat(count > 1, count)
        live = live[order][many]
        if not len(live):
            break
    return np.unique(group, return_inverse=True)[1]


def smallest(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The smallest document of each entry's key."""
    order = np.lexsort((doc, key))
    k = key[order]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    out = np.empty(len(key), np.int64)
    out[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


# Entries travel as columns of bytes, one row for each bucket and batch: the documents they are in
# (id steps and a checksum that parts rows with one id), how many entries each has, their places
# as steps, their lengths, and the digests. Of an anchor's digest 32 bits travel beside its
# bucket: two anchors that meet by chance are told apart by their windows. A single window has
# no anchor, as it is its own.
SENT = "bucket int, docs binary, sums binary, counts binary, places binary, sizes binary, anchors binary, wholes binary"


def packed(bucket: int, doc, sums, start, end, anchor, whole) -> tuple:
    order = np.lexsort((start, sums, doc))
    doc, sums, start, end = doc[order], sums[order], start[order], end[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (sums[1:] != sums[:-1])]))
    steps = np.diff(start, prepend=0)
    steps[new] = start[new]
    return (bucket, np.diff(doc[new], prepend=0).astype("<i8").tobytes(), sums[new].astype("<i4").tobytes(),
            np.diff(np.append(new, len(doc))).astype("<u4").tobytes(), steps.astype("<u4").tobytes(),
            (end - start).astype("<u4").tobytes(),
            b"" if anchor is None else anchor[order].astype("<u4").tobytes(),
            b"" if whole is None else whole[order].astype("<u8").tobytes())


def unpacked(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """(doc, sum, start, end, anchor, whole) of all entries of some rows."""
    parts = []
    for _, docs, sums, counts, places, sizes, anchors, wholes in rows:
        count = np.frombuffer(counts, "<u4").astype(np.int64)
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        steps = np.frombuffer(places, "<u4").astype(np.int64)
        run = np.cumsum(steps)
        start = run - np.repeat(run[first] - steps[first], count)
        parts.append((np.repeat(np.cumsum(np.frombuffer(docs, "<i8")), count), np.repeat(np.frombuffer(sums, "<i4"), count),
                      start, start + np.frombuffer(sizes, "<u4"), np.frombuffer(anchors, "<u4"), np.frombuffer(wholes, "<u8")))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _sent(doc, sums, start, end, anchor, whole, buckets: int) -> Iterator[tuple]:
    """One batch's entries by bucket; equal segments of larger documents are found here already."""
    repeat = doc > smallest(whole, doc)
    digit = whole if anchor is None else anchor
    if repeat.any():
        yield packed(int(digit[0] % np.uint64(buckets)), doc[repeat], sums[repeat], start[repeat], end[repeat], None, None)
    doc, sums, start, end, whole, digit = (x[~repeat] for x in (doc, sums, start, end, whole, digit))
    rest = None if anchor is None else digit // np.uint64(buckets) & np.uint64(0xFFFFFFFF)
    bucket = (digit % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        at = order[cut[b]:cut[b + 1]]
        yield packed(int(b), doc[at], sums[at], start[at], end[at], None if rest is None else rest[at], whole[at])


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(names)], [n for n, _ in names])


def _dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """Segments of all documents, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*hold)]
            if len(columns[0]):
                yield _table(list(_sent(*columns, buckets)), SENT)

        for batch in batches:
            data, offsets = arrays.flat(batch.column(2))
            row, start, end, anchor, whole = segments(data, offsets)
            ids, sums = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            hold.append((ids[row].astype(np.int64), sums[row].astype(np.int64), start, end, anchor, whole))
            size += len(data)
            if size >= SEND:
                yield from flush()
                hold, size = [], 0
        if hold:
            yield from flush()

    return docs.mapInArrow(run, SENT)


SPANS = "doc_id long, sum int, sure int, spans binary"


def _by_document(doc, sums, start, end, sure: int) -> Iterator[tuple]:
    order = np.lexsort((start, sums, doc))
    doc, sums = doc[order], sums[order]
    both = np.stack([start[order], end[order]], axis=1).astype("<u4")
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (sums[1:] != sums[:-1]), [True]])) if len(doc) else []
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(doc[a]), int(sums[a]), sure, both[a:b].tobytes()


def _met(sent: DataFrame) -> DataFrame:
    """What each bucket tells of documents: spans to remove (sure 1), segments to look into (0)."""

    def told(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        local = [r for r in rows if not r[7]]
        rest = [r for r in rows if r[7]]
        out = [x for r in local for x in _local(r)]
        if rest:
            doc, sums, start, end, anchor, whole = unpacked(rest)
            repeat = doc > smallest(whole, doc)
            out += _by_document(doc[repeat], sums[repeat], start[repeat], end[repeat], 1)
            if len(anchor):
                doc, sums, start, end, anchor, whole = (x[~repeat] for x in (doc, sums, start, end, anchor, whole))
                order = np.lexsort((whole, anchor))
                a, w = anchor[order], whole[order]
                new = np.concatenate([[True], a[1:] != a[:-1]])
                group = np.cumsum(new) - 1
                kinds = np.bincount(group, weights=np.concatenate([[True], w[1:] != w[:-1]]) | new)
                at = order[kinds[group] > 1]
                out += _by_document(doc[at], sums[at], start[at], end[at], 0)
        if out:
            yield _table(out, SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold: list[tuple] = []
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if hold and hold[0][0] != r[0]:
                    yield from told(hold)
                    hold = []
                hold.append(r)
        if hold:
            yield from told(hold)

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, SPANS)


def _local(row: tuple) -> Iterator[tuple]:
    """The spans of a row of repeats that were found where it was sent."""
    n = len(row[4]) // 4
    empty = np.zeros(n, "<u8").tobytes()
    doc, sums, start, end, _, _ = unpacked([(*row[:6], empty, empty)])
    yield from _by_document(doc, sums, start, end, 1)


def _windows(texts: DataFrame, unsure: DataFrame, buckets: int) -> DataFrame:
    """The single windows of the segments to look into, by bucket."""
    found = texts.join(unsure.groupBy("doc_id", "sum").agg(F.collect_list("spans").alias("spans")), ["doc_id", "sum"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            bodies, starts, docs, sums, places, base = [], [], [], [], [], 0
            for doc, s, text, spans in hold:
                both = np.frombuffer(b"".join(spans), "<u4").reshape(-1, 2).astype(np.int64)
                many = both[:, 1] - WINDOW - both[:, 0] + 1
                at = np.unique(np.repeat(both[:, 0] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()))
                bodies.append(np.frombuffer(text, np.uint8))
                starts.append(at + base)
                places.append(at)
                docs.append(np.full(len(at), doc))
                sums.append(np.full(len(at), s))
                base += len(text)
            data = np.concatenate(bodies)
            starts, places, docs, sums = (np.concatenate(x) for x in (starts, places, docs, sums))
            group = radix_groups(data, starts)
            _, one = np.unique(group, return_index=True)
            digest = np.empty(len(one), np.uint64)
            for lo in range(0, len(one), PIECE):
                digest[lo:lo + PIECE] = _digests(data, starts[one[lo:lo + PIECE]])
            yield _table(list(_sent(docs, sums, places, places + WINDOW, None, digest[group], buckets)), SENT)

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                hold.append(r)
                size += len(r[2]) + sum(len(x) for x in r[3])
                if size >= SEND // 4:
                    yield from flush()
                    hold, size = [], 0
        if hold:
            yield from flush()

    return found.select("doc_id", "sum", F.col("text").cast("binary"), "spans").mapInArrow(run, SENT)


def _digests(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.zeros(len(starts), np.uint64)
        for k in range(WINDOW):
            h = h * np.uint64(0x9E3779B97F4A7C15) + data[starts + k] + np.uint64(1)
    return arrays.mix(h)


def spans_of(raw: list[bytes]) -> np.ndarray:
    """Maximal runs covered by spans, as rows of start and end."""
    both = np.frombuffer(b"".join(raw), "<u4").reshape(-1, 2).astype(np.int64)
    both = both[np.argsort(both[:, 0], kind="stable")]
    reach = np.maximum.accumulate(both[:, 1])
    new = np.concatenate([[True], both[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(both)]]) - 1
    return np.stack([both[new, 0], reach[last]], axis=1)


def deduplicated(docs: DataFrame, text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, and what is kept if asked for."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("sum"),
                        F.col("text"))
    known = texts.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW))
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(BUCKETS, 2 * size // (WINDOW - ANCHOR + 2) // ENTRIES))
    first = stored(_met(_dealt(known, buckets)), "segments")
    release(docs.sparkSession)
    second = stored(_met(_windows(known, first.where("sure = 0"), buckets)), "windows")
    release(docs.sparkSession)
    found = first.where("sure = 1").union(second.where("sure = 1")).groupBy("doc_id", "sum").agg(
        F.collect_list("spans").alias("spans"))
    out = texts.join(found, ["doc_id", "sum"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, body, raw in zip(*[c.to_pylist() for c in batch.columns]):
                body = body or b""
                cut = spans_of(raw) if raw else np.zeros((0, 2), np.int64)
                kept, at = [], 0
                for a, b in cut.tolist():
                    kept.append(body[at:a])
                    at = b
                kept = b"".join([*kept, body[at:]])
                rows.append((doc, len(body), len(body) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds)], names[:n])

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    n = 6 if text else 5
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if text else "")
    return out.select("doc_id", F.col("text").cast("binary"), "spans").mapInArrow(run, schema)
