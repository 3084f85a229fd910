"""Benchmark decontamination by greedy string tiling.

Words are the runs of letters and digits of the lower-cased text. A document and a benchmark
item meet where they share ``LEAST`` words in a row, found by running (Karp-Rabin) hashes of
that many words. For such a pair the longest match of words that are not yet marked is marked,
again and again, until none of ``LEAST`` words is left; matches never overlap in either text.
The share of the item's words that lie in tiles is its coverage: it is the same in whatever
order the document has the passages. From ``COVERAGE`` on the document holds the item.

The benchmark is a stated query set: it is read in slices of at most ``SLICE_WORDS`` words,
each is sent to all tasks (a bounded broadcast), and the documents are scanned once for each slice.

Defined results: null or empty texts and items of fewer than ``LEAST`` words match nothing; an
item repeated in the benchmark is reported under each of its ids; repeated documents are
reported each; a null doc_id or item_id is carried along. Extra columns are ignored by
``contaminated`` and kept by ``clean``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pitchlake.llm import arrays

LEAST = 5
COVERAGE = 0.5
SLICE_WORDS = 1_000_000
#: Pairs of equal seeds that are looked at together.
PAIRS = 1 << 20

#: Bytes that part words: all of ASCII but letters and digits.
_APART = np.zeros(256, bool)
_APART[[c for c in range(128) if not chr(c).isalnum()]] = True


@dataclass
class Items:
    """A slice of the benchmark: word hashes, the item of each seed, seeds sorted by hash."""

    ids: list
    words: np.ndarray
    offsets: np.ndarray
    seeds: np.ndarray
    at: np.ndarray
    #: Bit map over the seeds' top bits, so that most words are told apart by one look.
    there: np.ndarray


_TOP = 22


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the n + 1 offsets of the texts in these."""
    data, offsets = arrays.flat(pc.utf8_lower(column.cast(pa.large_string())))
    hashes, firsts = [], []
    spaced = np.where(_APART[data], np.uint8(32), data)
    for lo, hi in arrays.slices(spaced, offsets):
        starts, ends = arrays.words(spaced, offsets, lo, hi)
        hashes.append(arrays.span_hashes(spaced[lo:hi], starts - lo, ends - lo))
        firsts.append(starts)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(firsts), offsets)


def items(ids: list, texts: list[str | None]) -> Items:
    words, offsets = word_hashes(pa.array(texts, pa.large_string()))
    seeds, at = arrays.shingle_hashes(words, offsets, LEAST)
    order = np.argsort(seeds, kind="stable")
    there = np.zeros(1 << _TOP, bool)
    there[(seeds >> np.uint64(64 - _TOP)).astype(np.int64)] = True
    return Items(ids, words, offsets, seeds[order], at[order], there)


def runs(keys: tuple[np.ndarray, ...], p: np.ndarray, q: np.ndarray, n: np.ndarray) -> tuple:
    """Runs of seeds joined with those that go on on the same diagonal: (keys, p, q, n), in order.

    ``n`` seeds start at text word ``p`` and item word ``q``; keys are the row and the item.
    """
    order = np.lexsort((p, p - q, *keys[::-1]))
    keys, p, q, n = tuple(k[order] for k in keys), p[order], q[order], n[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1] + n[:-1]) | (np.diff(p - q) != 0)
    for k in keys:
        new[1:] |= np.diff(k) != 0
    first = np.flatnonzero(new)
    return tuple(k[first] for k in keys), p[first], q[first], np.add.reduceat(n, first) if len(first) else n


def tiled(p: np.ndarray, q: np.ndarray, length: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(text word, item word, length) of the tiles, from maximal matches of ``length`` words.

    Longest first; among equals the first in the item, then in the text.
    """
    heap = [(-n, b, a) for n, b, a in zip(length.tolist(), q.tolist(), p.tolist())]
    heapq.heapify(heap)
    base, foot = int(p.min()), int(q.min())
    text = np.zeros(int((p + length).max()) - base, bool)
    item = np.zeros(int((q + length).max()) - foot, bool)
    out, left = [], len(item)
    while heap and left >= least:
        n, b, a = heapq.heappop(heap)
        n = -n
        own, other = text[a - base:a - base + n], item[b - foot:b - foot + n]
        marked = np.flatnonzero(own | other)
        if not len(marked):
            out.append((a, b, n))
            own[:] = other[:] = True
            left -= n
            continue
        cuts = np.concatenate([[-1], marked, [n]])
        for k in np.flatnonzero(np.diff(cuts) > least).tolist():  # free stretches of ``least`` or more
            start, size = int(cuts[k]) + 1, int(cuts[k + 1] - cuts[k]) - 1
            heapq.heappush(heap, (-size, b + start, a + start))
    return out


def tiles(p: np.ndarray, q: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The tiles from the pairs of places where seeds are equal."""
    _, p, q, n = runs((), p, q, np.ones(len(p), np.int64))
    return tiled(p, q, n + least - 1, least)


def matches(column: pa.Array, own: Items) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(row, item, tiles) of every pair that shares a seed.

    Seed pairs are made for about ``PAIRS`` at a time and kept as runs along their diagonals, so a
    word that a long text and an item repeat costs a run for each diagonal, not for each pair.
    """
    words, offsets = word_hashes(column)
    h, at = arrays.shingle_hashes(words, offsets, LEAST)
    maybe = np.flatnonzero(own.there[(h >> np.uint64(64 - _TOP)).astype(np.int64)])
    lo = np.searchsorted(own.seeds, h[maybe])
    hi = np.searchsorted(own.seeds, h[maybe], "right")
    some = hi > lo
    maybe, lo, many = maybe[some], lo[some], (hi - lo)[some]
    if not len(many):
        return
    total = np.cumsum(many)
    found, x = [], 0
    while x < len(many):
        y = max(x + 1, int(np.searchsorted(total, (total[x - 1] if x else 0) + PAIRS, "right")))
        m = many[x:y]
        place = np.repeat(at[maybe[x:y]], m)
        theirs = own.at[np.repeat(lo[x:y] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
        row = np.searchsorted(offsets, place, "right") - 1
        item = np.searchsorted(own.offsets, theirs, "right") - 1
        found.append(runs((row, item), place, theirs, np.ones(len(place), np.int64)))
        x = y
    (row, item), p, q, n = runs(
        tuple(np.concatenate([f[0][k] for f in found]) for k in (0, 1)), *[np.concatenate([f[k] for f in found]) for k in (1, 2, 3)])
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(item) != 0), [True]]))
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(row[a]), int(item[a]), tiled(p[a:b] - offsets[row[a]], q[a:b] - own.offsets[item[a]], n[a:b] + LEAST - 1)


def _slices(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark by slices of bounded size."""
    ids, texts, size = [], [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        if ids and size >= SLICE_WORDS:
            yield items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        size += len((r["text"] or "").split())
    if ids:
        yield items(ids, texts)


def _held(column: pa.Array, own: Items, coverage: float) -> Iterator[tuple[int, int, float, int]]:
    for row, item, found in matches(column, own):
        share = sum(n for *_, n in found) / int(own.offsets[item + 1] - own.offsets[item])
        if share >= coverage:
            yield row, item, share, len(found)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles) of every document and item it holds."""
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
              f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, coverage double, n_tiles int")
    out = None
    for part in _slices(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                found = list(_held(batch.column(1), own, coverage))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                     pa.array([own.ids[f[1]] for f in found]).cast(kind), pa.array([f[2] for f in found], pa.float64()),
                     pa.array([f[3] for f in found], pa.int32())], ["doc_id", "item_id", "coverage", "n_tiles"])

        kind = pa.array(part.ids).type if any(i is not None for i in part.ids) else pa.int64()
        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = one if out is None else out.union(one)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that hold no item, with the columns they came with."""
    at = docs.columns.index("text")
    for part in _slices(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in _held(batch.column(at), own, coverage)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
