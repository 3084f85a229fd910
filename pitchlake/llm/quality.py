"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

Words are runs of letters and digits; every other character that is no white space is a word of
its own, so that stray marks count. Single words and pairs in a row are hashed to ``BUCKETS``
weights, a text is the square roots of their counts scaled to length one, and its score is the
sparse dot product with the weights through a sigmoid. Weights come from per-coordinate FTRL
updates in numpy on at most about ``MAX_ROWS`` labelled rows, whose whole texts are hashed on
the executors.

Defined results: a null or empty text has no features and gets the bias's score; with nothing
to learn from every score is 0.5. Several labels of one document count as the smallest; rows
without a label are not learnt from. Repeated rows and null ids come out as they came in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import arrays

BITS = 18
BUCKETS = 1 << BITS
#: Bound of the training sample.
MAX_ROWS = 6000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
_ORDER = np.uint64(0xA0761D6478BD642F)

#: 0: white space, 1: letters, digits and all bytes of longer characters, 2: marks.
KIND = np.ones(256, np.uint8)
KIND[arrays.SPACE] = 0
for _c in range(33, 127):
    if not chr(_c).isalnum():
        KIND[_c] = 2


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _tokens(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    kind = KIND[data[lo:hi]]
    joined = np.zeros(hi - lo, bool)  # goes on with the byte before
    joined[1:] = (kind[1:] == 1) & (kind[:-1] == 1)
    inner = offsets[np.searchsorted(offsets, lo, "right"):np.searchsorted(offsets, hi, "left")] - lo
    joined[inner[(inner > 0) & (inner < hi - lo)]] = False
    starts = np.flatnonzero(~joined & (kind > 0))
    stop = ~joined
    stop[:-1] = ~joined[1:]
    stop[-1:] = True
    ends = np.flatnonzero(stop & (kind > 0)) + 1
    return starts, ends


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of every feature, by text."""
    hashes, firsts = [], []
    for lo, hi in arrays.slices(data, offsets):
        starts, ends = _tokens(data, offsets, lo, hi)
        hashes.append(arrays.span_hashes(data[lo:hi], starts, ends))
        firsts.append(starts + lo)
    if not hashes:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    h = np.concatenate(hashes)
    word_of = np.searchsorted(np.concatenate(firsts), offsets)
    text = arrays.runs(word_of)
    pairs, first = arrays.shingle_hashes(h, word_of, 2)
    shift = np.uint64(64 - BITS)
    with np.errstate(over="ignore"):
        key = np.concatenate([
            (text.astype(np.int64) << BITS) | (h >> shift).astype(np.int64),
            (text[first].astype(np.int64) << BITS) | ((pairs * _ORDER) >> shift).astype(np.int64)])
    key, count = np.unique(key, return_counts=True)
    text = key >> BITS
    norm = np.bincount(text, weights=count, minlength=len(offsets) - 1)
    return text, key & (BUCKETS - 1), np.sqrt(count / norm[text])


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 11) -> Model:
    """FTRL-proximal over (label, buckets, values)."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bias, bias_n = 0.0, 0.0
    rng = np.random.default_rng(seed)

    def weights(at) -> np.ndarray:
        free = np.abs(z[at]) > L1
        return np.where(free, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, at, x = rows[i]
            w = weights(at)
            err = 1 / (1 + np.exp(-np.clip(w @ x + bias, -35, 35))) - label
            g = err * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
            bias_n += err * err
            bias -= ALPHA / (BETA + np.sqrt(bias_n)) * err
    return Model(weights(slice(None)).astype(np.float32), float(bias))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, at, x = features(*arrays.flat(batch.column(1)))
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        cells = [slice(cut[i], cut[i + 1]) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), arrays.dense([at[c] for c in cells], np.int32),
             arrays.dense([x[c] for c in cells], np.float32)], ["label", "at", "x"])


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, label: str = "quality",
          max_rows: int = MAX_ROWS) -> Model:
    """Fit on the labelled rows where ``learn`` (over doc_id) holds; the sample is picked by hash of the id."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("_label"))
    total = known.count()
    if not total:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    span = 1 << 24
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(span * min(1.0, max_rows / total)))
    picked = picked.limit(2 * max_rows)  # so the sample may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    got = rows.select("_label", "text").mapInArrow(_counted, "label int, at binary, x binary").collect()
    got = sorted((r["label"], bytes(r["at"]), bytes(r["x"])) for r in got)
    return fit([(k, np.frombuffer(a, np.int32), np.frombuffer(x, np.float32)) for k, a, x in got])


def scores(model: Model, column: pa.Array) -> np.ndarray:
    data, offsets = arrays.flat(column)
    text, at, x = features(data, offsets)
    z = np.bincount(text, weights=model.weights[at] * x, minlength=len(offsets) - 1) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores(own, batch.column(1)), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
