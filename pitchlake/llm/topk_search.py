"""Exact top-k search by inner product over an impact-ordered, score-at-a-time index.

Entries become whole numbers. The rows are dealt by hash into shards of bounded size; a shard is
an index: for each dimension, posting segments of the rows whose entry falls into the same of
``LEVELS`` quantised levels. For a query, a segment's impact is |q| times the most that its
level adds above the dimension's lowest entry; a negative q reads the levels from the
other end. Segments of all dimensions are processed by descending impact, their impact is
added to the accumulators of their rows, and a row's accumulator plus the highest impact
not yet processed in each dimension it is missing from bounds its score from above. Rows are
left out only when that bound proves them below the k-th best exact score found so far; the
search of a shard stops when few possible members are left, or all segments are done, and these
are scored again exactly. Queries stream past the shard in batches; the best of each shard meet
in one window.

Defined results: a row takes no part if its vec_id is null or its vector is null, holds null or
non-finite entries, or entries beyond long integers. A query sees vectors of its own
length only. All rows with the query's vec_id count as its own; repeated rows of another vec_id
count once each, and each different vector of a repeated vec_id is a query. Scores beyond long
integers are the closest long. Ties go to the smaller vec_id. Empty vectors score zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm import vectors

FACTOR, K, EVERY = 256, 5, 50
LEVELS = 32
#: Rows of a shard at most, and of one where there are few (so that all cores search).
SHARD, LEAST, SHARDS = 65_536, 8192, 64
#: Shares of the postings after which possible members are counted, and the part of all rows
#: (one in so many) that is rather scored exactly than processed on.
CHECKS, FEW = (0.4, 0.5, 0.65, 0.8, 1.0), 6
_LONG = (1 << 63) - 1


class Index:
    """Posting segments of one shard's rows of one length."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        n, dim = x.shape
        low, high = self.x.min(axis=0), self.x.max(axis=0)
        self.low = low.astype(np.float64)
        width = (high.astype(np.float64) - self.low) / LEVELS
        above = self.x.astype(np.float64) - self.low
        level = np.minimum((above / np.where(width > 0, width, 1)).astype(np.int64), LEVELS - 1)
        key = level + np.arange(dim) * LEVELS
        by_level = [np.argsort(level[:, d], kind="stable") for d in range(dim)]
        self.rows = np.concatenate(by_level) if dim else np.zeros(0, np.int64)
        self.size = np.bincount(key.ravel(), minlength=dim * LEVELS)
        # The least and most above the lowest entry that each segment holds.
        least, most = np.full(dim * LEVELS, np.inf), np.zeros(dim * LEVELS)
        np.minimum.at(least, key.ravel(), above.ravel())
        np.maximum.at(most, key.ravel(), above.ravel())
        self.range = high.astype(np.float64) - self.low
        #: What a segment adds at most above the floor, read from the top level and from the lowest.
        self.up, self.down = most, np.where(self.size > 0, np.repeat(self.range, LEVELS) - least, 0)
        self.each_up, self.each_down = (np.repeat(g, self.size) for g in (self.up, self.down))

        top = vectors.largest(self.x)
        self.doubles = self.x.astype(np.float64) if top < 1 << 20 else None
        self.fits = vectors.EXACT // max(1, top * dim)

    def exact(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Scores as whole numbers."""
        if self.doubles is not None and vectors.largest(q) < self.fits:
            return (self.doubles[rows] @ q.astype(np.float64)).astype(np.int64)
        return vectors.product(self.x[rows], q[:, None])[:, 0]

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k rows with the highest scores, ties by smaller id (rows are in id order)."""
        rows, at = np.sort(rows), np.argsort(rows, kind="stable")
        first = np.argsort(-scores[at], kind="stable")[:k]
        return rows[first], scores[at][first]

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the k best rows but the query's own, and how many postings were processed."""
        n, dim = self.x.shape
        others = n - (np.searchsorted(self.ids, own, "right") - np.searchsorted(self.ids, own, "left"))
        mine = slice(np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right"))
        if others <= k or not dim or not q.any():
            rows = np.delete(np.arange(n), np.r_[mine])
            best = self._best(rows, self.exact(rows, q), k)
            return self.ids[best[0]], best[1], 0
        weight = np.abs(q).astype(np.float64)
        negative = q < 0
        # Impact of a segment: the most it can add above the floor of its dimension.
        impact = np.repeat(weight, LEVELS) * np.where(np.repeat(negative, LEVELS), self.down, self.up)
        use = np.flatnonzero((self.size > 0) & (np.repeat(weight, LEVELS) > 0))
        use = use[np.argsort(-impact[use], kind="stable")]
        dims, ends = use // LEVELS, np.cumsum(self.size[use])
        floor = float((np.where(negative, self.low + self.range, self.low) * q.astype(np.float64)).sum())
        most = impact.reshape(dim, LEVELS).max(axis=1)
        # One sum holds a row's impacts and, in whole steps, the dimensions it was found in.
        step = float(2 ** np.ceil(np.log2(most.sum() + 1) + 1))
        slack = 1e-9 * (float((weight * (self.range + np.abs(self.low))).sum()) + 1)
        acc, theta, passed = np.zeros(n), -np.inf, np.zeros(dim, np.int64)
        best: tuple = (np.zeros(0, np.int64), np.zeros(0))
        done = 0
        for stop in np.unique((np.searchsorted(ends, ends[-1] * np.array(CHECKS), "left") + 1).clip(max=len(use))):
            done = int(stop)
            # A dimension's impacts fall in the order of its levels: what was processed of it is one range.
            to = np.bincount(dims[:done], self.size[use[:done]], dim).astype(np.int64)
            found, gains = [], []
            for d in np.flatnonzero(to > passed).tolist():
                x, y = d * n + int(passed[d]), d * n + int(to[d])
                if not negative[d]:
                    x, y = (2 * d + 1) * n - y, (2 * d + 1) * n - x
                found.append(self.rows[x:y])
                gains.append((self.each_down if negative[d] else self.each_up)[x:y] * weight[d] + step)
            acc += np.bincount(np.concatenate(found), np.concatenate(gains), n)
            passed = to
            # Where a dimension is begun, a row it was not found in adds at most the next impact.
            seen = np.floor(acc / step)
            begun = passed > 0
            tau = float(impact[use[done]]) if done < len(use) else 0.0
            bound = floor + (acc - seen * step) + float(most[~begun].sum()) + (int(begun.sum()) - seen) * tau
            bound[mine] = -np.inf
            lead = np.argpartition(-bound, k - 1)[:k]
            theta = max(theta, float(min(self.exact(lead, q))))
            possible = np.flatnonzero(bound >= theta - slack)
            if len(possible) <= max(k, n // FEW) or done == len(use):
                best = self._best(possible, self.exact(possible, q), k)
                break
        return self.ids[best[0]], best[1], int(ends[done - 1])


def _rows(table: DataFrame, factor: int) -> DataFrame:
    """(vec_id, x) of the rows that take part: whole numbers as bytes of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for rows, c in vectors.matrices(batch.column(1)):
                x, fits = vectors.scaled(c, factor)
                keep = known[rows[fits]]
                rows, x = rows[fits][keep], x[keep]
                small = vectors.largest(x) < 1 << 15  # two bytes an entry are enough for unit vectors
                raw = [r.tobytes() for r in np.ascontiguousarray(x, np.int16 if small else np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)).cast(pa.int64()), pa.array(raw, pa.binary()),
                     pa.array(np.full(len(rows), 2 if small else 8, np.int32)),
                     pa.array(np.full(len(rows), x.shape[1], np.int32))], ["vec_id", "x", "width", "dim"])

    return table.select("vec_id", "embedding").mapInArrow(run, "vec_id long, x binary, width int, dim int")


def _matrix(raw: list[bytes], widths: list[int], dim: int) -> np.ndarray:
    out = np.zeros((len(raw), dim), np.int64)
    for width, kind in ((2, np.int16), (8, np.int64)):
        at = [i for i, w in enumerate(widths) if w == width]
        if at:
            out[at] = np.frombuffer(b"".join([raw[i] for i in at]), kind).reshape(len(at), dim)
    return out


def search(table: DataFrame, is_query, k: int = K, factor: int = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row where ``is_query`` holds."""
    spark = table.sparkSession
    total = table.select("vec_id").count()
    shards = max(-(-total // SHARD), min(SHARDS, -(-total // LEAST)), 1)
    rows = _rows(table, factor)
    # A row's place in its shard does not depend on its vector, so copies of one are spread.
    stored_rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "x"), F.lit(shards)).cast("int"))
    queries = rows.where(is_query).dropDuplicates(["vec_id", "x"])
    sent = stored_rows.select("shard", F.lit(0).alias("role"), "dim", "vec_id", "x", "width").union(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("role"),
                       "dim", "vec_id", "x", "width"))
    sent = sent.repartition(shards, "shard").sortWithinPartitions("shard", "role", "dim", "vec_id", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index = None, {}, None
        for batch in batches:
            cols = {c: batch.column(i).to_pylist() for i, c in enumerate(batch.schema.names)}
            out: tuple[list, list, list, list] = ([], [], [], [])
            for i in range(batch.num_rows):
                if cols["shard"][i] != now:
                    now, held, index = cols["shard"][i], {}, None
                dim = cols["dim"][i]
                if cols["role"][i] == 0:
                    own = held.setdefault(dim, ([], [], []))
                    for part, c in zip(own, ("vec_id", "x", "width")):
                        part.append(cols[c][i])
                    continue
                if index is None:
                    index = {d: Index(np.array(v[0], np.int64), _matrix(v[1], v[2], d)) for d, v in held.items()}
                    held = {}
                if dim not in index:
                    continue
                q = _matrix([cols["x"][i]], [cols["width"][i]], dim)[0]
                ids, scores, _ = index[dim].search(cols["vec_id"][i], q, k)
                out[0].extend([cols["vec_id"][i]] * len(ids))
                out[1].extend(ids.tolist())
                out[2].extend(max(-_LONG - 1, min(_LONG, int(s))) for s in scores)
                out[3].extend([cols["x"][i]] * len(ids))
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[3], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())],
                    ["query_id", "q", "vec_id", "score"])

    best = sent.mapInArrow(run, "query_id long, q binary, vec_id long, score long")
    order = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), F.col("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
