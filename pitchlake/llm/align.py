"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level BPE on a blank plus the text, B a SentencePiece model on the text (which puts
that blank first itself). Every text is tokenised whole by both. A blank that stands between
two other characters starts a token in both, so the tokens of a part between such blanks
depend on that part alone; they are kept in a bounded table, as parts come back often.

Anchors are byte offsets where a token that starts with a blank begins in A and in B, and so
the tokens before them end together; this is verified on the ends of all tokens. Anchors split
a document into windows of token ids. The alignment of a window depends on its ids alone
and is kept by them: its groups (cut where tokens of both end), and its links (pairs of
tokens whose bytes overlap).

How many documents hold an id pair linked is counted in blocks: a task writes, beside each
document's links as numbers of its own pair table, that table with the documents it counted. The
tables are added up over the corpus, each A id's highest count is found, and both go back to
the block's table only; then a block's documents meet its table. So neither a frequent pair nor
the corpus-wide table is ever in one place, and nothing is broadcast but the two vocabularies.

Defined results: texts that are null or empty, or whose tokens' bytes joined (A's or B's) differ
from blank plus text, have no tokens: zeros and an empty digest column. Rows come out as they
came in, repeated ones too, each counted as a document of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import pieces
from pitchlake.llm.common import stored

#: A blank between two characters that no version of Unicode counts as white space.
BLANK = re.compile("(?<=[^\\s\\u180e\\u200b\\ufeff]) (?=[^\\s\\u180e\\u200b\\ufeff])")
#: Longest part that is kept, parts and windows that a worker keeps, most tokens of a kept window.
PART, PARTS, WINDOWS, WINDOW = 64, 150_000, 400_000, 48
#: Pairs, documents, and links of different windows that a block is closed after.
PAIRS, DOCS, LINKS = 1_000_000, 50_000, 8_000_000
TEXTS = 64
_SHIFT = 32


def _outer(c: str) -> bool:
    """A character beside which a blank need not start a token."""
    return c.isspace() or c in "\u180e\u200b\ufeff"


def byte_of_letter() -> dict[str, int]:
    """Bytes by the letters that byte-level vocabularies write for them.

    Printable Latin-1 letters stand for themselves, the other bytes, in order, for those from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Files:
    """What the two vocabulary files hold; both are of fixed size."""

    a_json: str
    b_model: bytes
    b_pieces: list[str]
    b_byte: list[int]


def load(a_path: str, b_path: str) -> Files:
    v = pieces.load(b_path)  # also checks that blanks only start pieces
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return Files(a.read(), b.read(), v.pieces, v.byte)


class Tokens:
    """Both tokenizers, the bytes of their tokens, and the ids of parts seen before."""

    def __init__(self, files: Files):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b_model)
        letter = byte_of_letter()
        vocabulary = json.loads(files.a_json)["model"]["vocab"]
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in vocabulary.items():
            if all(c in letter for c in token):
                self.a_bytes[i] = bytes(letter[c] for c in token)
        self.b_bytes = [bytes([x]) if x >= 0 else p.replace("▁", " ").encode() for p, x in zip(files.b_pieces, files.b_byte)]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.a_blank = np.array([x[:1] == b" " for x in self.a_bytes])
        self.b_blank = np.array([x[:1] == b" " for x in self.b_bytes])
        self.parts: dict[str, tuple[bytes, bytes, bool]] = {}
        self.before: dict[str, tuple[bytes, bytes, bool]] = {}  # the parts kept before these

    def _coded(self, found: list[str]) -> dict[str, tuple[bytes, bytes, bool]]:
        """A's and B's ids of blank plus part, and whether their bytes are just these."""
        joint = [p for p in found if not (_outer(p[0]) or _outer(p[-1]) or "▁" in p)]
        out = self._joint(joint)
        for part in found:
            if part not in out:
                a, b = self.a.encode(" " + part, add_special_tokens=False).ids, self.b.encode(part)
                whole = (" " + part).encode()
                same = all(b"".join([t[i] for i in ids]) == whole for ids, t in ((a, self.a_bytes), (b, self.b_bytes)))
                out[part] = (np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes(), same)
        return out

    def _joint(self, found: list[str]) -> dict[str, tuple[bytes, bytes, bool]]:
        """The same for parts encoded as one text, cut where both sides' tokens end with a part; else none."""
        if not found:
            return {}
        text = " ".join(found)
        whole = (" " + text).encode()
        ends = np.cumsum([1 + len(p.encode()) for p in found])
        sides = []
        for ids, table, size in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes, self.a_size),
                                 (self.b.encode(text), self.b_bytes, self.b_size)):
            if b"".join([table[i] for i in ids]) != whole:
                return {}
            ids = np.array(ids, np.int32)
            sizes = np.cumsum(size[ids])
            at = np.searchsorted(sizes, ends)
            if (sizes[at] != ends).any():
                return {}
            raw, cuts = ids.tobytes(), (4 * (at + 1)).tolist()
            sides.append([raw[i:j] for i, j in zip([0, *cuts], cuts)])
        return {p: (x, y, True) for p, x, y in zip(found, *sides)}

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A's and B's ids of each text; none where joined bytes differ from blank plus text."""
        cut = [BLANK.split(t) if t else [] for t in texts]
        known, before = self.parts, self.before
        new = list({p for c in cut for p in c if p not in known and p not in before})
        once = self._coded(new) if new else {}
        out = []
        for text, c in zip(texts, cut):
            both = [known.get(p) or before.get(p) or once[p] for p in c]
            a = np.frombuffer(b"".join([x[0] for x in both]), np.int32)
            b = np.frombuffer(b"".join([x[1] for x in both]), np.int32)
            if not all([x[2] for x in both]):  # judged on the whole text
                whole = (" " + text).encode()
                if b"".join([self.a_bytes[i] for i in a.tolist()]) != whole or \
                        b"".join([self.b_bytes[i] for i in b.tolist()]) != whole:
                    a = b = np.zeros(0, np.int32)
            out.append((a, b))
        if len(known) > PARTS:
            self.before, self.parts = known, {}
        self.parts.update((p, x) for p, x in once.items() if len(p) <= PART)
        return out


class _Grown:
    """An array that grows by doubling."""

    def __init__(self):
        self.room, self.used = np.zeros(1024, np.int64), 0

    def add(self, more: np.ndarray) -> None:
        need = self.used + len(more)
        if need > len(self.room):
            self.room = np.concatenate([self.room, np.zeros(max(need, len(self.room)), np.int64)])
        self.room[self.used:need] = more
        self.used = need


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of all ranges in a row."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Windows:
    """Alignments by ids, and the numbers of the pairs they link."""

    def __init__(self, tokens: Tokens):
        self.t = tokens
        n, m = len(tokens.a_bytes), len(tokens.b_bytes)
        # How an id is written, by whether it is the last of its side in a group.
        self.written = [f"{i}{e}" for i in range(n) for e in ",|"] + [f"{i}{e}" for i in range(m) for e in ",;"]
        self.b_first = 2 * n
        self.clear()

    def clear(self) -> None:
        self.number: dict[int, int] = {}  # pair -> its number in the block
        self.kept: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.n_groups, self.pairs, self.starts, self.sizes = _Grown(), _Grown(), _Grown(), _Grown()

    def _made(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """Align windows that lie in a row, and append them.

        Both sides' ends together cut the bytes into stretches; each lies in one token of A and
        one of B, which it links. A group ends where both end.
        """
        a_ends, b_ends = np.cumsum(self.t.a_size[a]), np.cumsum(self.t.b_size[b])
        ends = np.union1d(a_ends, b_ends)
        i, j = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        shared = (a_ends[i] == ends) & (b_ends[j] == ends)
        at = np.searchsorted(a_ends[np.cumsum(n_a) - 1], ends)
        codes, inverse = np.unique((a[i].astype(np.int64) << _SHIFT) | b[j], return_inverse=True)
        number = self.number
        numbers = np.array([number.setdefault(c, len(number)) for c in codes.tolist()], np.int64)
        sizes = np.bincount(at, minlength=len(n_a))
        self.starts.add(self.pairs.used + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.pairs.add(numbers[inverse])
        self.n_groups.add(np.bincount(at[shared], minlength=len(n_a)))
        cuts = ends[shared]
        ga, gb = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        last = lambda g: np.append(g[1:] != g[:-1], True)
        order = np.argsort(np.concatenate([2 * ga, 2 * gb + 1]), kind="stable")
        codes = np.concatenate([2 * a + last(ga), self.b_first + 2 * b + last(gb)])[order]
        written = self.written
        text = [written[c] for c in codes.tolist()]
        to = np.cumsum(n_a + n_b).tolist()
        self.groups.extend(["".join(text[x:y]) for x, y in zip([0, *to], to)])

    def anchors(self, a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token indexes in A and in B at which windows start, for texts in a row that start at the given tokens."""
        sa, sb = self.t.a_size[a], self.t.b_size[b]
        a_starts, b_starts = np.cumsum(sa) - sa, np.cumsum(sb) - sb
        x, y = self.t.a_blank[a], self.t.b_blank[b]
        x[a_first] = y[b_first] = True
        x, y = np.flatnonzero(x), np.flatnonzero(y)
        # Verified: both start at the same byte, so the tokens before both end there.
        _, i, j = np.intersect1d(a_starts[x], b_starts[y], assume_unique=True, return_indices=True)
        return x[i], y[j]

    def of(self, ids: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """The windows of documents in a row, and how many each document has."""
        n_a, n_b = (np.array([len(d[k]) for d in ids], np.int64) for k in (0, 1))
        if not n_a.sum():
            return np.zeros(0, np.int64), np.zeros(len(ids), np.int64)
        a, b = (np.concatenate([d[k] for d in ids]).astype(np.int64) for k in (0, 1))
        some = n_a > 0
        first = (np.cumsum(n_a) - n_a)[some]
        at, bt = self.anchors(a, b, first, (np.cumsum(n_b) - n_b)[some])
        counts = np.zeros(len(ids), np.int64)
        counts[some] = np.diff(np.append(np.searchsorted(at, first), len(at)))
        n_a, n_b = np.diff(np.append(at, len(a))), np.diff(np.append(bt, len(b)))
        # A window's ids, those of A and then those of B, lie together: they are its key.
        which = np.arange(len(at))
        order = np.argsort(np.concatenate([np.repeat(which, n_a), np.repeat(which, n_b)]), kind="stable")
        raw = np.concatenate([a, b | 1 << 20])[order].astype(np.int32).tobytes()
        cuts = (4 * np.append(at + bt, len(a) + len(b))).tolist()
        keys = [raw[i:j] for i, j in zip(cuts, cuts[1:])]
        kept = self.kept
        out = list(map(kept.get, keys))
        new: dict[bytes, int] = {}
        for k, w in enumerate(out):
            if w is None:
                new.setdefault(keys[k], k)
        if new:
            base = len(self.groups)
            k = np.fromiter(new.values(), np.int64, len(new))
            self._made(a[_ranges(at[k], n_a[k])], n_a[k], b[_ranges(bt[k], n_b[k])], n_b[k])
            made = dict(zip(new, range(base, base + len(new))))
            out = [made[key] if w is None else w for key, w in zip(keys, out)]
            kept.update((key, w) for key, w in made.items() if len(key) <= 4 * WINDOW)
        return np.array(out, np.int64), counts

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pair numbers of all windows in a row, where each begins, how many it has, and its groups."""
        return self.pairs.room, self.starts.room, self.sizes.room, self.n_groups.room


_worker: tuple | None = None


def _tokens(files: Files) -> Tokens:
    """The worker's tokenizers; it keeps its parts between tasks."""
    global _worker
    key = (len(files.a_json), hash(files.a_json), hash(files.b_model))
    if _worker is None or _worker[0] != key:
        _worker = (key, Tokens(files))
    return _worker[1]


def _packed(numbers: np.ndarray, times: np.ndarray) -> bytes:
    steps = np.diff(numbers, prepend=0).astype(np.uint32)
    planes = np.concatenate([steps, times.astype(np.uint32)]).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8)
    both = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.int64), both[half:].astype(np.int64)


_DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_NAMES = [x.split()[0] for x in _DOC.split(", ")]


def _blocks(docs: DataFrame, files: Files, id_column: str) -> DataFrame:
    """Rows of documents (with their links, packed) and, at the end of a block, its pair table."""
    shared = docs.sparkSession.sparkContext.broadcast(files)  # vocabulary files
    kind = docs.schema[id_column].dataType.simpleString()
    names = ["block", "id", *_NAMES, "links", "numbers", "a", "b", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared.value)
        windows = Windows(tokens)
        own = TaskContext.get().partitionId() << 24
        counts = np.zeros(0, np.int64)
        held = 0
        id_type = None

        def table() -> pa.RecordBatch:
            used = np.flatnonzero(counts)
            codes = np.fromiter(windows.number, np.int64, len(windows.number))[used]
            lists = [pa.array([x.astype(t)], pa.list_(k)) for x, t, k in (
                (used, np.int32, pa.int32()), (codes >> _SHIFT, np.int32, pa.int32()),
                (codes & ((1 << _SHIFT) - 1), np.int32, pa.int32()), (counts[used], np.int64, pa.int64()))]
            none = [pa.nulls(1, id_type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), *none, *lists], names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids = tokens.ids([t or "" for t in part.column(1).to_pylist()])
                flat, sizes = windows.of(ids)
                n = len(ids)
                links, n_groups, packed, text = np.zeros(n, np.int64), np.zeros(n, np.int64), [b""] * n, [""] * n
                if len(flat):
                    numbers, starts, lens, groups = windows.tables()
                    of_doc = np.repeat(np.arange(n), sizes)
                    n_groups = np.bincount(of_doc, groups[flat], n).astype(np.int64)
                    lens = lens[flat]
                    pos = _ranges(starts[flat], lens)
                    doc = np.repeat(of_doc, lens)
                    links = np.bincount(doc, minlength=n)
                    own_text = windows.groups
                    ends = np.cumsum(sizes)
                    text = ["".join([own_text[w] for w in flat[i:j].tolist()])[:-1] for i, j in zip(ends - sizes, ends)]
                    total = len(windows.number)
                    pairs, times = np.unique(doc * total + numbers[pos], return_counts=True)
                    doc, pairs = pairs // total, pairs % total
                    if total > len(counts):
                        counts = np.concatenate([counts, np.zeros(total - len(counts), np.int64)])
                    counts += np.bincount(pairs, minlength=len(counts))  # each pair once a document
                    ends = np.searchsorted(doc, np.arange(n + 1))
                    packed = [_packed(pairs[i:j], times[i:j]) if j > i else b"" for i, j in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, own, np.int64)), part.column(0),
                    pa.array([len(a) for a, _ in ids], pa.int64()), pa.array([len(b) for _, b in ids], pa.int64()),
                    pa.array(n_groups), pa.array(links, pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in text], pa.string()),
                    pa.array(packed, pa.binary()), *[pa.nulls(n, pa.list_(pa.int32()))] * 3, pa.nulls(n, pa.list_(pa.int64()))], names)
                held += n
                if held >= DOCS or len(windows.number) >= PAIRS or len(windows.groups) >= WINDOWS or windows.pairs.used >= LINKS:
                    yield table()
                    windows.clear()
                    counts, held, own = np.zeros(0, np.int64), 0, own + 1
        if held:
            yield table()

    return docs.select(F.col(id_column).alias("id"), "text").mapInArrow(
        run, f"block long, id {kind}, {_DOC}, links binary, numbers array<int>, a array<int>, b array<int>, docs array<long>")


def align(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    rows = stored(_blocks(docs, load(a_path, b_path), id_column), "blocks")
    entries = rows.where("numbers is not null").select(
        "block", F.explode(F.arrays_zip("numbers", "a", "b", "docs")).alias("e")).select("block", "e.*")
    counts = stored(entries.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("high"))
    judged = counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("high")).alias("best"))
    back = entries.join(judged, ["a", "b"])
    kind = docs.schema[id_column].dataType.simpleString()
    sent = back.select("block", F.lit(0).alias("role"), "numbers", "n", "best", F.lit(None).cast(kind).alias("id"),
                       *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in _DOC.split(", ")],
                       F.lit(None).cast("binary").alias("links"))
    sent = sent.union(rows.where("numbers is null").select(
        "block", F.lit(1).alias("role"), F.lit(0).alias("numbers"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("best"),
        "id", *_NAMES, "links"))
    sent = sent.repartition("block").sortWithinPartitions("block", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, table = None, [], None
        for batch in batches:
            block, role = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(role) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(i, j - i)
                if block[i] != now:
                    now, held, table = block[i], [], None
                if role[i] == 0:
                    held.append([part.column(c).to_numpy(zero_copy_only=False) for c in (2, 3, 4)])
                    continue
                if table is None:
                    number, n, best = (np.concatenate([h[c] for h in held]) for c in range(3)) if held else [np.zeros(0, np.int64)] * 3
                    table = np.zeros((2, int(number.max()) + 1 if len(number) else 0), np.int64)
                    table[0, number], table[1, number] = n, best
                    held = []
                sums, bests = [], []
                for raw in part.column(11).to_pylist():
                    pairs, times = _unpacked(raw) if raw else (np.zeros(0, np.int64),) * 2
                    sums.append(int((table[0][pairs] * times).sum()))
                    bests.append(int((table[1][pairs] * times).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(5), *[part.column(c) for c in (6, 7, 8, 9)], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()),
                     part.column(10)], [id_column, *_NAMES[:4], "n_best", "count_sum", "groups_sha256"])

    return sent.mapInArrow(
        run, f"`{id_column}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
