"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the runs of two and three characters of the lower-cased text in which every
character that is no letter counts as a blank; runs without a letter are left out. Each run is
hashed to one of ``BUCKETS`` embeddings, a text is the mean of its embeddings, and a linear
softmax over the mean gives the language. Training is stochastic gradient descent in numpy on
at most about ``MAX_ROWS`` labelled rows, dealt evenly over the languages; their whole texts
are hashed on the executors and only counts reach the driver. A fifth of them is kept apart to
calibrate: a temperature, and two bounds that reject a text as in no learned language. Each starts
from what all but ``QUANTILE`` of these rows reach, whatever their label. Too many subwords are
unknown above the share the rows stay under plus ``UNSEEN``, plus ``SPREAD`` times the spread of such
a count in a text of that length; labels have no part in it. A score is too low below ``LIFT`` of
the way from chance to what the rows reach: wrong labels lower all scores, and the bound with them.

Defined results: a null, empty or letterless text is ``und`` with score 0.0 and is rejected;
with nothing to learn from every text is; with fewer than five rows to learn from none is kept
apart, and only letterless texts are rejected; ties go to the language first in the alphabet. Rows
are never dropped, merged or looked up by id, so repeated rows and null ids come out as they
came in; extra columns are ignored by ``predict`` and kept by ``accepted``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
DIM = 16
#: Bound of the training sample, over all languages together.
MAX_ROWS = 2000
EPOCHS = 6
RATE = 0.5
#: Share of the calibration rows beyond a bound without its margin, and the margins.
QUANTILE, UNSEEN, SPREAD, LIFT = 0.01, 0.03, 4.0, 0.1
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
SLICE = 1 << 20


@dataclass
class Model:
    langs: list[str]
    #: Per bucket, the share of each language's logit, already divided by the temperature.
    table: np.ndarray
    bias: np.ndarray
    known: np.ndarray
    least_score: float
    #: Before the spread of a text's length is taken off.
    least_known: float


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def subwords(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords, and the character where each starts.

    ``codes`` holds pieces one after another, ``ends`` tells where they end; the last two
    characters of a piece start nothing.
    """
    is_letter = letters()[codes]
    c = np.where(is_letter, codes, 32).astype(np.uint64)
    with np.errstate(over="ignore"):
        two = (c[:-2] * _A) ^ (c[1:-1] * _B)
        three = ((two ^ (c[2:] * _C)) * _A) >> np.uint64(48)
        two = (two * _C) >> np.uint64(48)
    ok = is_letter[:-2] | is_letter[1:-1]
    ok3 = ok | is_letter[2:]
    seams = ends[:-1]
    for back in (1, 2):
        ok[seams - back] = ok3[seams - back] = False
    at, at3 = np.flatnonzero(ok), np.flatnonzero(ok3)
    return np.concatenate([two[at], three[at3]]).astype(np.int64), np.concatenate([at, at3])


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(text, codes): a blank before and two after each text, long ones cut with an overlap of two."""
    for i, text in enumerate(texts):
        codes = np.concatenate([[32], _codes(text or ""), [32, 32]]).astype(np.uint32)
        for at in range(0, len(codes) - 2, SLICE):
            yield i, codes[at:at + SLICE + 2]


def features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their counts for each text."""
    out = []
    for text in texts:
        counts = np.zeros(BUCKETS, np.int64)
        for _, codes in _pieces([text]):
            counts += np.bincount(subwords(codes, np.array([len(codes)]))[0], minlength=BUCKETS)
        at = np.flatnonzero(counts)
        out.append((at.astype(np.int32), counts[at].astype(np.float32)))
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """Model from (language, buckets, counts); None when no row has a subword."""
    rows = [r for r in rows if len(r[1])]
    langs = sorted({r[0] for r in rows})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = {int(i) for i in order[: len(rows) // 5]}
    train = [rows[i] for i in range(len(rows)) if i not in held]
    tests = [rows[i] for i in sorted(held)] or train
    y = {x: i for i, x in enumerate(langs)}
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    w = np.zeros((DIM, len(langs)))
    w += rng.normal(0, 0.1, w.shape)
    bias = np.zeros(len(langs))
    known = np.zeros(BUCKETS, bool)
    steps, total = 0, EPOCHS * len(train)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(train)):
            lang, at, n = train[i]
            known[at] = True
            share = n / n.sum()
            mean = share @ emb[at]
            err = _softmax(mean @ w + bias)
            err[y[lang]] -= 1
            rate = RATE * (1 - steps / total)
            back = w @ err
            w -= rate * np.outer(mean, err)
            bias -= 0.1 * rate * err
            # A mean over many subwords passes little to each: scaled up by their number.
            emb[at] -= rate * np.minimum(1.0, share * len(at))[:, None] * back
            steps += 1
    table = emb @ w
    logits = np.array([(n / n.sum()) @ table[at] + bias for _, at, n in tests])
    truth = np.array([y[r[0]] for r in tests])
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    heat = grid[int(np.argmin(loss))]
    score = _softmax(logits / heat)
    best = score.max(axis=1)
    seen = np.array([n[known[at]].sum() / n.sum() for _, at, n in tests])
    chance = 1 / len(langs)
    least_score = chance + LIFT * (float(np.quantile(best, QUANTILE)) - chance)
    least_known = float(np.quantile(seen, QUANTILE)) - UNSEEN
    if not held:
        least_score = least_known = 0.0
    return Model(langs, (table / heat).astype(np.float32), bias / heat, known, least_score, least_known)


def score(model: Model | None, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the language's index (-1: und), the score, and whether it is rejected."""
    n = len(texts)
    if model is None:
        return np.full(n, -1), np.zeros(n), np.ones(n, bool)
    size = len(model.langs)
    sums, count, known = np.zeros((n, size)), np.zeros(n), np.zeros(n)
    columns = [np.ascontiguousarray(model.table[:, k]) for k in range(size)]
    hold: list[np.ndarray] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if not hold:
            return
        lengths = [len(x) for x in hold]
        buckets, starts = subwords(np.concatenate(hold), np.cumsum(lengths))
        which = np.repeat(np.array(owner), lengths)[starts]
        for k in range(size):
            sums[:, k] += np.bincount(which, weights=columns[k][buckets], minlength=n)
        count[:] += np.bincount(which, minlength=n)
        known[:] += np.bincount(which, weights=model.known[buckets], minlength=n)
        hold.clear()
        owner.clear()
        held = 0

    for i, codes in _pieces(texts):
        hold.append(codes)
        owner.append(i)
        held += len(codes)
        if held >= SLICE:
            flush()
    flush()
    some = count > 0
    each = np.maximum(count, 1)
    p = _softmax(sums / each[:, None] + model.bias)
    lang = np.where(some, p.argmax(axis=1), -1)
    best = np.where(some, p.max(axis=1), 0.0)
    most = (1 - model.least_known) * count
    return lang, best, ~some | (best < model.least_score) | (count - known > most + SPREAD * np.sqrt(most))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f = features(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([a.tobytes() for a, _ in f], pa.binary()),
             pa.array([c.tobytes() for _, c in f], pa.binary())], ["lang", "at", "n"])


def train(docs: DataFrame, learn: Column | None = None, max_rows: int = MAX_ROWS) -> Model | None:
    """Fit on the rows of ``docs`` where ``learn`` holds and lang and text are not null.

    A row is in the sample by the hash of its id, at a rate per language that makes the
    expected sample ``max_rows`` in all; rarer languages give every row.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if learn is not None:
        rows = rows.where(learn)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = max(1, max_rows // len(counts))
    span = 1 << 24
    cuts = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, int(span * min(1.0, share / n)))])
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(span)) < cuts[F.col("lang")])
    got = picked.select("lang", "text").mapInArrow(_counted, "lang string, at binary, n binary").limit(2 * max_rows).collect()
    got = sorted((r["lang"], bytes(r["at"]), bytes(r["n"])) for r in got)
    return fit([(k, np.frombuffer(a, np.int32), np.frombuffer(n, np.float32)) for k, a, n in got])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lang, best, rejected = score(own, batch.column(1).to_pylist())
            found = pa.array([own.langs[i] if i >= 0 else "und" for i in lang], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), found, pa.array(best, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows that are not rejected, with the columns they came with."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~score(shared.value, batch.column(at).to_pylist())[2]))

    return docs.mapInArrow(run, docs.schema)
