"""Language-model scoring: causal self-attention over subword ids, and a word base.

Words are the runs between ASCII white space of the text with A-Z lower-cased; each text ends
with one end token. The base is the smoothed unigram of these words, counted over all training
documents. The model predicts subword ids: every word is encoded by the prefix table of
``pieces``, and a block of causal self-attention with a small feed-forward layer gives, from the
ids before, a distribution over groups of ``MEMBERS`` classes and one over the classes of each group;
an id's share of its class is its smoothed count over all training words. The frequent ids have a class of their own.

The counts cover the whole corpus, and every id of every training text is learnt from: texts are cut into
windows that follow one another, each id the target of one. The windows are dealt over tasks of
``LOCAL`` batches a round or more by document and place, so copies of a text do not meet; in each of ``ROUNDS`` rounds a task runs Adam over its share in numpy from the
weights so far, and the tasks' weights are averaged. A corpus that gives fewer than ``STEPS`` batches
is passed over more often; any larger one is learnt from in proportion to its size, once.

A text is scored in windows of ``WINDOW`` ids that overlap by half: each id is scored once, in the
first window that has it, after at least half a window of context, and later windows use the overlap
as context only. Windows are computed in batches under one causal mask.

Documents are gathered into blocks of about ``SEND`` bytes; a block keeps its distinct words once and
its texts as places in them. The blocks' words are dealt out by word, where each is counted
(a window sum that spills, in the JVM) and encoded, and go back to their block with both, so no
task or broadcast holds the vocabulary of the corpus. A word has a row for each block it is in,
however often it is there.

Defined results: a null or empty text is one end token; with no training text all counts are
zero and the weights untrained; rows with a null id are no training rows; repeated rows are
scored and counted each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm import arrays, pieces
from pitchlake.llm.common import release, scratch

#: Bytes of text in a block.
SEND = 8 << 20
#: Bytes of a group of rows in a file: a writer holds one at once.
TOLD = 16 << 20
DIM, INNER, WINDOW, STRIDE = 16, 32, 48, 24
CLASSES, MEMBERS = 576, 24
#: Ids with an embedding of their own, by count; the rest share one.
SLOTS = 2048
MIXED = 0.5
#: Windows of a batch.
BATCH = 48
#: Batches of all passes at least, rounds between which weights are averaged, and batches of a task in a round at least.
STEPS, ROUNDS, LOCAL = 1200, 3, 400
RATE = 0.01
#: Windows scored together.
TOGETHER = 128


# ---- model -------------------------------------------------------------------------------------

def start(classes: np.ndarray, slots: int = SLOTS, seed: int = 1) -> dict[str, np.ndarray]:
    """Untrained weights: ``classes`` gives the class of each id."""
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    s = DIM ** -0.5
    groups = int(classes.max()) // MEMBERS + 1
    return {
        "emb": normal(slots, DIM, scale=0.3), "place": normal(WINDOW, DIM, scale=0.05),
        "q": normal(DIM, DIM, scale=s), "k": normal(DIM, DIM, scale=s), "v": normal(DIM, DIM, scale=s),
        "o": normal(DIM, DIM, scale=s), "up": normal(DIM, INNER, scale=s), "down": normal(INNER, DIM, scale=INNER ** -0.5),
        "out": normal(DIM, groups, scale=0.1), "bias": np.zeros(groups, np.float32),
        "deep": normal(groups, DIM, MEMBERS, scale=0.1),
        "deep_bias": np.where(np.bincount(classes, minlength=groups * MEMBERS) > 0, 0, -30).astype(np.float32).reshape(groups, MEMBERS),
    }


_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


def _beside(x: np.ndarray, last: np.ndarray | float) -> np.ndarray:
    """``x`` with one more column."""
    out = np.empty((*x.shape[:-1], x.shape[-1] + 1), x.dtype)
    out[..., :-1], out[..., -1] = x, last
    return out


def _products(w: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """What one place asks of another (``q`` and ``k`` as one matrix), ``v`` and ``o`` as one, embeddings with a one beside them, places with a zero."""
    s = w["q"].dtype.type(DIM ** -0.5)
    return (w["q"] @ w["k"].T) * s, w["v"] @ w["o"], _beside(w["emb"], 1), _beside(w["place"], 0)


def _attended(made: tuple[np.ndarray, ...], ids: np.ndarray, since: int = 0) -> tuple[np.ndarray, ...]:
    """Inputs with a one beside them, what each place from ``since`` on asks, exponents, their sums, and the means of the inputs by these.

    A place's question meets the inputs themselves and the mean of the inputs is what ``v`` and ``o`` then
    turn, so inputs are multiplied by one matrix before and one after. Exponents are taken relative
    to their row's largest only where some are too large or too small for that to be left out.
    """
    asks, _, emb, place = made
    n = ids.shape[1]
    x = emb.take(ids, axis=0)
    x += place[:n]
    y = (x[:, since:, :DIM].reshape(-1, DIM) @ asks).reshape(len(ids), n - since, DIM)
    e = y @ x[..., :DIM].transpose(0, 2, 1)
    plain = e.size == 0 or (e.max() < 60 and e.min() > -60)
    e[..., since:] += _MASK[since:n, since:n]
    if not plain:
        e -= e.max(axis=2, keepdims=True)
    np.exp(e, out=e)
    mean = (e @ x).reshape(-1, DIM + 1)
    total = mean[:, DIM:]
    return x, y, e, total, mean[:, :DIM] / total


def forward(w: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Hidden state at each place of each window, and what the gradient needs."""
    made = _products(w)
    x, y, e, total, mean = _attended(made, ids)
    h = mean @ made[1]
    h += x[..., :DIM].reshape(-1, DIM)
    inner = h @ w["up"]
    np.maximum(inner, 0, out=inner)
    top = inner @ w["down"]
    top += h
    return top.reshape(*ids.shape, DIM), (made, x, y, e, total, mean, h, inner)


def hidden(w: dict[str, np.ndarray], ids: np.ndarray, since: int = 0, made: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
    """The hidden states of ``forward`` from a place on; ``made`` are the weights' products where they are at hand."""
    made = made or _products(w)
    x, _, _, _, mean = _attended(made, ids, since)
    h = mean @ made[1]
    h += x[:, since:, :DIM].reshape(-1, DIM)
    inner = h @ w["up"]
    np.maximum(inner, 0, out=inner)
    top = inner @ w["down"]
    top += h
    return top.reshape(len(ids), ids.shape[1] - since, DIM)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def _chosen(z: np.ndarray, at: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of the log softmax of each column at one place, and its gradient, which takes the place of ``z``."""
    each = np.arange(len(at))
    z -= z.max(axis=0)
    p = z[at, each]
    np.exp(z, out=z)
    total = z.sum(axis=0)
    z /= total
    z[at, each] -= 1
    return float((p - np.log(total)).sum()), z


def _summed(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by the place each goes to."""
    n = rows.shape[1]
    cell = (at * n)[:, None] + np.arange(n)
    return np.bincount(cell.ravel(), rows.ravel(), size * n).astype(rows.dtype).reshape(size, n)


def _heads(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the groups and of each group's classes, a row each, with the bias as last column."""
    return _beside(w["out"].T, w["bias"]), _beside(w["deep"].transpose(0, 2, 1), w["deep_bias"])


def _grouped(top: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The chosen rows as columns, with a one below."""
    out = np.empty((DIM + 1, len(at)), top.dtype)
    out[:DIM], out[DIM] = top.take(at, axis=0).T, 1
    return out


def _parts(group: np.ndarray, groups: int) -> list[tuple[int, slice]]:
    """Each group that occurs, and where it lies."""
    cuts = np.searchsorted(group, np.arange(groups + 1)).tolist()
    return [(one, slice(lo, hi)) for one, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]


def _members(heads: np.ndarray, hidden: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """Scores of the classes of each column's own group."""
    out = np.empty((MEMBERS, hidden.shape[1]), hidden.dtype)
    for one, own in parts:
        np.matmul(heads[one], hidden[:, own], out=out[:, own])
    return out


def gradient(w: dict[str, np.ndarray], ids: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss and gradients; ``target`` is the class of the next id, -1 where there is none.

    Places are taken in the order of their group, so each group is one product; scores lie in columns,
    so that a softmax runs along whole rows. A bias is one more column of its weights.
    """
    top, ((asks, gives, _, _), x1, y, e, total, mean, h, inner) = forward(w, ids)
    top = top.reshape(-1, DIM)
    flat = target.ravel()
    real = np.flatnonzero(flat >= 0)
    real = real[np.argsort((flat[real] // MEMBERS).astype(np.uint16), kind="stable")]
    group, member = np.divmod(flat[real], MEMBERS)
    hidden = _grouped(top, real)
    out, deep = _heads(w)
    parts = _parts(group, len(out))
    count = np.float32(1 / max(1, len(real)))
    lp, dz = _chosen(out @ hidden, group)
    lm, dm = _chosen(_members(deep, hidden, parts), member)
    loss = -(lp + lm) * float(count)
    dz *= count
    dm *= count
    rows, own_rows, back = dz @ hidden.T, np.zeros_like(deep), np.empty((DIM, len(real)), top.dtype)
    turned = deep[..., :DIM].transpose(0, 2, 1)
    for one, own in parts:
        np.matmul(dm[:, own], hidden[:, own].T, out=own_rows[one])
        np.matmul(turned[one], dm[:, own], out=back[:, own])
    back += w["out"] @ dz
    g = {"out": rows[:, :DIM].T, "bias": rows[:, DIM], "deep": own_rows[..., :DIM].transpose(0, 2, 1), "deep_bias": own_rows[..., DIM]}
    dtop = np.zeros_like(top)
    dtop[real] = back.T
    n = ids.shape[1]
    x = x1[..., :DIM]
    g["down"] = inner.T @ dtop
    dinner = dtop @ w["down"].T
    dinner *= inner > 0
    g["up"] = h.T @ dinner
    dh = dinner @ w["up"].T
    dh += dtop
    turn = mean.T @ dh  # gradient of v and o as one matrix
    g["o"], g["v"] = w["v"].T @ turn, turn @ w["o"].T
    dmean = np.empty((len(dh), DIM + 1), top.dtype)
    np.matmul(dh, gives.T, out=dmean[:, :DIM])
    dmean[:, DIM] = -np.einsum("ij,ij->i", dmean[:, :DIM], mean)  # what the weights' own gradients sum to
    dmean /= total
    dmean = dmean.reshape(x1.shape)
    de = dmean @ x1.transpose(0, 2, 1)
    de *= e
    dy = (de @ x).reshape(-1, DIM)
    dx = dh
    dx += (e.transpose(0, 2, 1) @ dmean[..., :DIM]).reshape(-1, DIM)
    dx += (de.transpose(0, 2, 1) @ y).reshape(-1, DIM)
    dx += dy @ asks.T
    ask = (x.reshape(-1, DIM).T @ dy) * w["q"].dtype.type(DIM ** -0.5)  # gradient of q and k as one matrix
    g["q"], g["k"] = ask @ w["k"], ask.T @ w["q"]
    g["place"] = np.zeros_like(w["place"])
    g["place"][:n] = dx.reshape(-1, n, DIM).sum(axis=0)
    g["emb"] = _summed(dx, ids.ravel(), len(w["emb"]))
    return loss, g


def adam(w: dict[str, np.ndarray], windows: np.ndarray, classes: np.ndarray, slot: np.ndarray,
         passes: int, rate: float, seed: int) -> list[float]:
    """Adam over windows of WINDOW + 1 ids (-1: past the end); changes ``w``, returns the losses."""
    rng = np.random.default_rng(seed)
    flat = _flat(w)  # all weights as one vector, of which ``w`` gets the parts
    w.update(_shaped(flat, w))
    m, s, step = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)  # sums of gradients and of their squares, ten and a hundred times the means
    class_of, slot_of = np.append(classes, -1), np.append(slot, slot[0])  # -1 takes the last
    losses: list[float] = []
    steps = passes * -(-len(windows) // BATCH)
    for _ in range(passes):
        order = rng.permutation(len(windows))
        for lo in range(0, len(windows), BATCH):
            t = len(losses) + 1
            own = windows[order[lo:lo + BATCH]]
            loss, g = gradient(w, slot_of[own[:, :-1]], class_of[own[:, 1:]])
            losses.append(loss)
            now = rate * min(1.0, t / 50) * (1 - t / (steps + 1))
            all_ = _flat(g)
            m *= 0.9
            m += all_
            all_ *= all_
            s *= 0.99
            s += all_
            scale = (0.01 / (1 - 0.99 ** t)) ** 0.5
            np.sqrt(s, out=step)
            step += 1e-8 / scale
            np.divide(m, step, out=step)
            step *= now * 0.1 / (1 - 0.9 ** t) / scale
            flat -= step
    return losses


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32, copy=False)
        at += like[k].size
    return out


def fit(w: dict[str, np.ndarray], windows: DataFrame, classes: np.ndarray, slot: np.ndarray) -> dict[str, np.ndarray]:
    """Weights learnt from all windows (ids binary, and what tells them apart): passes of tasks over their shares, averaged after each round."""
    spark = windows.sparkSession
    columns = sorted(windows.columns)
    dealt = windows.select(F.xxhash64(*columns).alias("deal"), F.pmod(F.xxhash64(*columns, F.lit(7)), F.lit(ROUNDS)).cast("int").alias("part"), "ids")
    windows, at = _kept(dealt, "windows")
    release(spark)
    total = windows.count()
    if not total:
        return w
    batches_ = -(-total // BATCH)
    passes = max(1, -(-STEPS // batches_))
    tasks = max(1, batches_ // (ROUNDS * LOCAL))  # the mean of weights that few steps changed has learnt little
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast((w, classes, slot))  # of fixed size

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw = b"".join(arrays.flat(batch.column(0))[0].tobytes() for batch in batches)
            if raw:
                own = np.frombuffer(raw, "<i4").reshape(-1, WINDOW + 1)
                own = own[np.argsort(own.view(f"V{own.itemsize * own.shape[1]}").ravel(), kind="stable")]  # however they came
                mine = {k: x.copy() for k, x in sent.value[0].items()}
                adam(mine, own, *sent.value[1:], max(1, round(passes / ROUNDS)), RATE * (1 - r / ROUNDS), r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(_flat(mine).astype(np.float64) * len(own)).tobytes()], pa.binary()), pa.array([len(own)], pa.int64())], ["w", "n"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total_, n = None, 0
            for batch in batches:
                for x, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    x = np.frombuffer(x, np.float64)
                    total_, n = x if total_ is None else total_ + x, n + c
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([total_.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["w", "n"])

        share = windows
        if passes < ROUNDS:  # a round has its own part of the windows, so each is passed over once
            share = windows.where(F.col("part") == r)
        learnt = share.select("ids", "deal").repartition(tasks, "deal").select("ids").mapInArrow(learn, "w binary, n long")
        few = max(1, int(tasks ** 0.5))  # sums meet in the root of the tasks, then on the driver
        rows = learnt.repartition(few, F.xxhash64("w")).sortWithinPartitions(F.xxhash64("w")).mapInArrow(add, "w binary, n long").collect()
        rows = sorted((bytes(x["w"]), x["n"]) for x in rows)
        if rows:
            w = _shaped(sum(np.frombuffer(x, np.float64) for x, _ in rows) / sum(n for _, n in rows), w)
        del share, learnt
        release(spark)  # each round's files go before the next
    _drop(spark, at)
    return w


def class_table(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each id, the log share of each id in its class, and the slot of its embedding.

    All but an eighth of the classes go to the most frequent ids, one each; the rest of the ids
    are dealt by order of count into classes of about equal count.
    """
    order = np.argsort(-counts, kind="stable")
    alone = min(len(counts), CLASSES - CLASSES // 8)
    classes = np.empty(len(counts), np.int64)
    classes[order[:alone]] = np.arange(alone)
    rest = order[alone:]
    if len(rest):
        mass = np.cumsum(counts[rest] + 0.5)
        classes[rest] = alone + np.minimum(CLASSES // 8 - 1, (mass / mass[-1] * (CLASSES // 8)).astype(np.int64))
    classes = np.unique(classes, return_inverse=True)[1]
    smooth = counts + 0.5
    slot = np.full(len(counts), SLOTS - 1)
    slot[order[:SLOTS - 1]] = np.arange(min(len(counts), SLOTS - 1))
    return classes, np.log(smooth / np.bincount(classes, weights=smooth)[classes]).astype(np.float32), slot


def id_scores(w, classes: np.ndarray, share: np.ndarray, slot: np.ndarray, stream: np.ndarray, offsets: np.ndarray,
              bos: int) -> np.ndarray:
    """Natural log probability of each id of the texts in ``stream``, whose offsets are given."""
    n = np.diff(offsets)
    many = np.where(n > WINDOW, 1 + -(-(n - WINDOW) // STRIDE), (n > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    own = slot[stream]
    target = classes[stream]
    out = np.zeros(len(stream), np.float32)
    first = nth == 0  # all of a text's first window is scored, then the later half of each
    made, (groups, deep) = _products(w), _heads(w)
    for which, since in ((np.flatnonzero(first), 0), (np.flatnonzero(~first), WINDOW - STRIDE)):
        for lo in range(0, len(which), TOGETHER):
            t, j = text[which[lo:lo + TOGETHER]], nth[which[lo:lo + TOGETHER]]
            place = j[:, None] * STRIDE + np.arange(WINDOW)[None, :]  # of the id to be scored
            width = int(min(WINDOW, (n[t] - j * STRIDE).max()))
            place = place[:, :width]
            at = offsets[t][:, None] + np.minimum(place, n[t][:, None] - 1)
            before = np.where(place > 0, own[np.maximum(at - 1, 0)], slot[bos])
            scored = np.flatnonzero((place < n[t][:, None])[:, since:])
            at = at[:, since:].ravel()[scored]
            order = np.argsort((target[at] // MEMBERS).astype(np.uint16), kind="stable")
            at = at[order]
            top = _grouped(hidden(w, before, since, made).reshape(-1, DIM), scored[order])
            group, member = np.divmod(target[at], MEMBERS)
            p = _log_share(groups @ top, group)
            out[at] = p + _log_share(_members(deep, top, _parts(group, len(groups))), member)
    return out + share[stream]


def _log_share(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax of each column at one place; changes ``z``."""
    z -= z.max(axis=0)
    p = z[at, np.arange(len(at))]
    np.exp(z, out=z)
    return p - np.log(z.sum(axis=0))


# ---- corpus ------------------------------------------------------------------------------------

BLOCK = ("block long, ids array<long>, held array<boolean>, sizes binary, words array<string>, "
         "counts array<int>, places binary")


def _distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words and the place of each word in these."""
    coded = words.dictionary_encode()
    place = coded.indices.to_numpy(zero_copy_only=False)
    try:
        return coded.dictionary.cast(pa.string()), place
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        again = pa.array([w.decode("utf-8", "replace") for w in coded.dictionary.to_pylist()], pa.string()).dictionary_encode()
        return again.dictionary, again.indices.to_numpy(zero_copy_only=False)[place]


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents: texts as places in the block's distinct words, with training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold, size, number = [], 0, TaskContext.get().partitionId() << 32

        def made() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in hold])
            held, sizes, lengths, body = (np.concatenate([h[k] for h in hold]) for k in range(1, 5))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            words, place = _distinct(pa.Array.from_buffers(
                pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(body)]))
            counts = np.bincount(place, weights=np.repeat(~held, sizes), minlength=len(words)).astype(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (
                ids, pa.array(held, pa.bool_()), words, pa.array(counts, pa.int32()))]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), lists[0], lists[1], pa.array([sizes.astype("<u4").tobytes()], pa.binary()),
                 lists[2], lists[3], pa.array([place.astype("<u4").tobytes()], pa.binary())],
                ["block", "ids", "held", "sizes", "words", "counts", "places"])

        for batch in batches:
            data, offsets = arrays.flat(batch.column(2))
            data = arrays.LOWER[data]
            starts, ends = [], []
            for lo, hi in arrays.slices(data, offsets):
                a, b = arrays.words(data, offsets, lo, hi)
                starts.append(a)
                ends.append(b)
            starts, ends = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends))
            hold.append((batch.column(0).cast(pa.int64()), batch.column(1).to_numpy(zero_copy_only=False),
                         np.diff(np.searchsorted(starts, offsets)), ends - starts, data[~arrays.SPACE[data]]))
            size += len(data)
            if size >= SEND:
                yield made()
                hold, size, number = [], 0, number + 1
        if hold:
            yield made()

    return docs.mapInArrow(run, BLOCK)


MET = "block long, i int, c long, sub binary, new boolean"


def _kind(size: int) -> np.dtype:
    """What holds an id of so many subwords."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def encoded(words: list[str], m, coder: pieces.Coder, opens: np.ndarray) -> list[bytes]:
    """Ids of each word, as the library gives them for all words as one text.

    A blank opens a piece and is in none but at its start, so the ids fall apart where a piece
    starts with one; words that hold the blank's own mark are encoded alone.
    """
    plain = [w for w in words if pieces.BLANK not in w]
    ids = np.array(m.encode(" ".join(plain)), np.uint32) if plain else np.zeros(0, np.uint32)
    starts = np.flatnonzero(opens[ids])
    if len(starts) != len(plain):  # then each for itself
        return [coder.encode(w, keep=False) for w in words]
    raw, cuts = ids.astype("<u4").tobytes(), (4 * np.append(starts, len(ids))).tolist()
    out = iter([raw[a:b] for a, b in zip(cuts, cuts[1:])])
    return [coder.encode(w, keep=False) if pieces.BLANK in w else next(out) for w in words]


def _met(pairs: DataFrame, shared) -> DataFrame:
    """(block, i, n, word) by word -> each row with the word's count and ids; ``new`` marks one row of each word.

    Counts are window sums, which spill; the ids are made for the distinct words of a batch, so a word
    that every block has is never held at once.
    """
    whole = Window.partitionBy("word")
    counted = pairs.select(  # a block has a word once
        "block", "i", F.sum("n").over(whole).alias("c"), (F.min("block").over(whole) == F.col("block")).alias("new"), "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = shared.value
        coder, m, opens = _encoder(vocabulary, model)
        kind = _kind(len(vocabulary.pieces))

        def told(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            block, i, c, new, word = (pa.concat_arrays([b.column(k) for b in rows]) for k in range(5))
            words = word.dictionary_encode()
            data, ends = arrays.flat(pa.array(encoded(words.dictionary.to_pylist(), m, coder, opens), pa.binary()))
            sub = np.frombuffer(data.tobytes(), "<u4").astype(kind)
            ids = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
                None, pa.py_buffer((ends // 4 * kind.itemsize).astype(np.int32)), pa.py_buffer(sub)])
            return pa.RecordBatch.from_arrays([block, i, c, ids.take(words.indices), new], ["block", "i", "c", "sub", "new"])

        hold: list[pa.RecordBatch] = []
        for batch in batches:
            hold.append(batch)
            if sum(b.num_rows for b in hold) >= 8192:  # words are short: some thousand together
                yield told(hold)
                hold = []
        if hold:
            yield told(hold)

    return counted.mapInArrow(run, MET)


_library: tuple | None = None


def _encoder(vocabulary: pieces.Vocabulary, model: bytes):
    """The worker's coder, the library's encoder, and which pieces start with a blank."""
    global _library
    if _library is None or _library[0] != model:
        import sentencepiece

        opens = np.array([p.startswith(pieces.BLANK) for p in vocabulary.pieces])
        _library = (model, sentencepiece.SentencePieceProcessor(model_proto=model), opens)
    return pieces.coder(vocabulary), _library[1], _library[2]


def _take(flat: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` chosen by ``at``, one after another, and their lengths."""
    n = np.diff(offsets)[at]
    return flat[np.repeat(offsets[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())], n


def subword_counts(met: DataFrame, size: int) -> np.ndarray:
    """Count of every subword id over all training words."""

    kind = _kind(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            data, offsets = arrays.flat(batch.column(0))
            n = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(offsets) // kind.itemsize)
            total += np.bincount(np.frombuffer(data.tobytes(), kind), weights=n, minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], ["id", "n"])

    out = np.zeros(size)
    words = met.where("new and c > 0").select("sub", "c")
    for r in words.mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def _texts(batch: pa.RecordBatch, b: int, kind: np.dtype) -> tuple:
    """A block's (ids, held, words of each text, places, counts of its words, their subwords, offsets of these)."""
    ids, held, sizes, places, words = (batch.column(k)[b] for k in range(5))
    if words.is_valid:
        order = np.argsort(words.values.field("i").to_numpy(zero_copy_only=False))
        known = words.values.field("c").to_numpy(zero_copy_only=False)[order].astype(np.float64)
        data, sub_of = arrays.flat(words.values.field("sub").take(pa.array(order)))
        sub, sub_of = np.frombuffer(data.tobytes(), kind).astype(np.int64), sub_of // kind.itemsize
    else:  # texts without a word
        known, sub, sub_of = np.zeros(0), np.zeros(0, np.int64), np.zeros(1, np.int64)
    n = np.frombuffer(sizes.as_py(), "<u4").astype(np.int64)
    return ids.values, held.values, n, np.frombuffer(places.as_py(), "<u4"), known, sub, sub_of


def cut(stream: np.ndarray, offsets: np.ndarray, bos: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, nth, ids): windows of WINDOW + 1 ids (-1: past the end) with every id of ``stream`` once behind another.

    A text's first id follows ``bos``; a window begins with the last id of the one before.
    """
    n = np.diff(offsets)
    many = -(-n // WINDOW)
    text = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    place = nth[:, None] * WINDOW + np.arange(WINDOW + 1)[None, :] - 1
    ids = stream[offsets[text][:, None] + np.clip(place, 0, n[text][:, None] - 1)]
    return text, nth, np.where(place < 0, bos, np.where(place < n[text][:, None], ids, -1)).astype("<i4")


def _rows(x: np.ndarray) -> pa.Array:
    """One binary value for each row."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def windows_of(blocks: DataFrame, bos: int, eos: int, kind: np.dtype) -> DataFrame:
    """(doc_id, nth, ids): the windows of every training text of blocks that met their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                ids, held, n, place, _, sub, sub_of = _texts(batch, b, kind)
                own = np.flatnonzero(~held.to_numpy(zero_copy_only=False))
                names_ = ids.fill_null(0).to_numpy(zero_copy_only=False)[own]
                place = place[np.repeat(~held.to_numpy(zero_copy_only=False), n)]
                offsets = np.concatenate([[0], np.cumsum(n[own])])
                lo = 0
                while lo < len(own):  # about a hundred thousand words together
                    hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + 100_000, "right")) - 1)
                    flat, each = _take(sub, sub_of, place[offsets[lo]:offsets[hi]])
                    ends = np.concatenate([[0], np.cumsum(each)])[offsets[lo + 1:hi + 1] - offsets[lo]]
                    stream = np.insert(flat, ends, eos)
                    text, nth, windows = cut(stream, np.concatenate([[0], ends + np.arange(1, hi - lo + 1)]), bos)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names_[lo:hi][text].astype(np.int64)), pa.array(nth.astype(np.int64)), _rows(windows)], ["doc_id", "nth", "ids"])
                    lo = hi

    return blocks.mapInArrow(run, "doc_id long, nth long, ids binary")


def _kept(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder, well compressed, and where."""
    path = scratch(df.sparkSession, purpose)
    df.write.option("compression", "zstd").option("parquet.block.size", TOLD).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _drop(spark, *paths: str) -> None:
    """Remove copies that no later step reads."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _pairs(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "w")).select(
        "block", "i", F.col("w.words").alias("word"), F.col("w.counts").cast("long").alias("n"))


def _with_words(blocks: DataFrame, met: DataFrame) -> DataFrame:
    """Blocks with the counts and ids of their words."""
    looked = met.groupBy("block").agg(F.collect_list(F.struct("i", "c", "sub")).alias("words"))
    return blocks.select("block", "ids", "held", "sizes", "places").join(looked, "block", "left").drop("block")


def training_windows(docs: DataFrame, shared) -> DataFrame:
    """``windows_of`` all of ``docs`` (doc_id, text), each a training text."""
    blocks = _blocks(docs.select("doc_id", F.lit(False).alias("held"), "text"))
    vocabulary = shared.value[0]
    kind = _kind(len(vocabulary.pieces))
    return windows_of(_with_words(blocks, _met(_pairs(blocks), shared)), vocabulary.bos, vocabulary.eos, kind)


def score(docs: DataFrame, held: Column, model: str) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    vocab = pieces.load(model)
    with open(model, "rb") as file:
        shared = spark.sparkContext.broadcast((vocab, file.read()))  # a tokenizer's file: bounded
    size = len(vocab.pieces)
    kind = _kind(size)
    out_ = F.coalesce(held, F.lit(False)) | F.col("doc_id").isNull()
    source = docs.select("doc_id", out_.alias("held"), "text")
    blocks, _ = _kept(_blocks(source), "blocks")
    met, _ = _kept(_met(_pairs(blocks), shared), "words")
    release(spark)
    texts = int(source.where("not held").count())
    total, distinct = met.where("new and c > 0").agg(F.sum("c"), F.count("*")).first()
    n_all = int(total or 0) + texts
    v_all = distinct + (texts > 0)
    subwords = subword_counts(met, size)
    subwords[vocab.eos] += texts
    classes, share, slot = class_table(subwords)
    joined = _with_words(blocks, met)
    weights = fit(start(classes), windows_of(joined, vocab.bos, vocab.eos, kind), classes, slot)
    fitted = spark.sparkContext.broadcast((weights, classes, share, slot))
    under = float(np.log10(n_all + 0.5 * (v_all + 1)))
    end_share = float(np.log(MIXED * texts / max(1, n_all) + 1e-300))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = fitted.value
        for batch in batches:
            for b in range(batch.num_rows):
                ids, held_, n, place, known, sub, sub_of = _texts(batch, b, kind)
                doc = np.repeat(np.arange(len(n)), n)
                base = np.bincount(doc, weights=np.log10(known + 0.5)[place], minlength=len(n))
                part = np.log(MIXED * known / max(1, n_all) + 1e-300)
                base += np.log10(texts + 0.5) - (n + 1) * under
                n_known = np.bincount(doc, weights=(known > 0)[place], minlength=len(n)).astype(np.int64) + (texts > 0)
                scores = np.zeros(len(n))
                offsets = np.concatenate([[0], np.cumsum(n)])
                lo = 0
                while lo < len(n):  # about a hundred thousand words together
                    hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + 100_000, "right")) - 1)
                    flat, each = _take(sub, sub_of, place[offsets[lo]:offsets[hi]])
                    own = np.bincount(doc[offsets[lo]:offsets[hi]] - lo, weights=each, minlength=hi - lo).astype(np.int64)
                    ends = np.cumsum(own)
                    stream = np.insert(flat, ends, vocab_eos)
                    p = id_scores(*model_, stream, np.concatenate([[0], ends + np.arange(1, hi - lo + 1)]), vocab_bos)
                    # Tokens are the words and each text's end: their ids' sum, mixed with their share.
                    stop = np.cumsum(n[lo:hi])
                    ids_of = np.insert(each, stop, 1)
                    by_share = np.insert(part[place[offsets[lo]:offsets[hi]]], stop, end_share)
                    first = np.concatenate([[0], np.cumsum(ids_of)[:-1]])
                    by_model = np.add.reduceat(p.astype(np.float64), first) + np.log(1 - MIXED)
                    mixed = np.maximum(by_model, by_share) + np.log(1 + np.exp(-np.abs(by_model - by_share)))
                    scores[lo:hi] = np.bincount(np.repeat(np.arange(hi - lo), n[lo:hi] + 1), weights=mixed, minlength=hi - lo)
                    lo = hi
                scores /= np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [ids, held_, pa.array(n + 1), pa.array(n_known), pa.array(np.full(len(n), n_all)),
                     pa.array(base), pa.array(scores)], names)

    vocab_bos, vocab_eos = vocab.bos, vocab.eos
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return joined.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

