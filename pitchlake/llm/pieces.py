"""SentencePiece encoding and decoding by a table of prefixes, for merge-type (BPE) models.

The encoding of a prefix of a text is the encoding of the text cut at some token, so each
prefix has one last token. An automaton gives all pieces that end at a character; the last
token of that prefix is the one piece that is compatible with the last token of the prefix
before it, where two pieces are compatible if merging their joined text gives just these two
again. The ids are then read backwards from the end of the text.

No piece has a blank after another character, and a character without a piece never merges,
so a text falls apart at blanks and at such characters: parts are encoded alone, and short
parts are kept in a bounded table, since they come back often. Characters without a piece
become the pieces of their UTF-8 bytes.

Defined results: a null or empty text has the begin and end ids alone and decodes to the empty
text. Rows come out as they came in, with whatever id they have; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLANK = "▁"
#: Longest part that is kept, and how many parts and pairs a task keeps.
PART, PARTS, PAIRS = 48, 400_000, 1_000_000


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ID = np.dtype("<u4")


@dataclass
class Vocabulary:
    """What a model file holds: pieces by id, and the special ids."""

    pieces: list[str]
    scores: list[float]
    #: Byte of each id that stands for one, else -1.
    byte: list[int]
    control: set[int]
    bos: int
    eos: int
    unk: int


def load(path: str) -> Vocabulary:
    """Read a model file. Only merge-type models with byte pieces, a dummy prefix and no normalisation."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    pieces = [m.id_to_piece(i) for i in range(n)]
    byte = [int(p[3:5], 16) if m.is_byte(i) else -1 for i, p in enumerate(pieces)]
    control = {i for i in range(n) if m.is_control(i) or m.is_unknown(i) or m.is_unused(i)}
    if sum(b >= 0 for b in byte) != 256 or any(BLANK in p.lstrip(BLANK) for p in pieces):
        raise ValueError("a model with all byte pieces and blanks only at the start of pieces is needed")
    return Vocabulary(pieces, [m.get_score(i) for i in range(n)], byte, control, m.bos_id(), m.eos_id(), m.unk_id())


class Coder:
    """Encodes and decodes; one per Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        self.own = {p: i for i, p in enumerate(v.pieces) if v.byte[i] < 0 and i not in v.control}
        self.size = len(v.pieces)
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the parts kept before these
        self.pieces = ahocorasick.Automaton()
        chars = {c for p in self.own for c in p}
        lone = sorted(c for c in chars if c not in self.own)  # such a character merges only into longer pieces
        for p, i in self.own.items():
            if len(p) == 1 or self.merged(p) == [p]:
                self.pieces.add_word(p, (len(p), i))
        self.lone = {c: self.size + k for k, c in enumerate(lone)}
        for c, i in self.lone.items():
            self.pieces.add_word(c, (1, i))
        self.pieces.make_automaton()
        self.text_of = v.pieces + lone
        odd = "[^" + re.escape("".join(sorted(chars - {BLANK}))) + "]"
        self.cut = re.compile(f"{BLANK}+(?:(?!{odd}).)*|(?:(?!{odd}).)+|{odd}", re.S) if chars else re.compile(".", re.S)
        self.chars = chars
        self.out = [b"" if i in v.control else bytes([v.byte[i]]) if v.byte[i] >= 0
                    else p.replace(BLANK, " ").encode() for i, p in enumerate(v.pieces)]
        self.of_byte = {b: i for i, b in enumerate(v.byte) if b >= 0}

    def merged(self, text: str) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, until nothing merges."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.own.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.v.scores[i] > best):
                    best, at = self.v.scores[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        left, right = self.text_of[a], self.text_of[b]
        ok = self.merged(left + right) == [left, right]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[a * (2 * self.size) + b] = ok
        return ok

    def last_tokens(self, text: str) -> list[tuple[int, int]]:
        """(length, id) of the last token of each prefix but the empty one."""
        table: list = [None] * (len(text) + 1)
        table[0] = (0, -1)
        pairs, wide = self.pairs, 2 * self.size
        for end, match in self.pieces.iter(text):
            end += 1
            if table[end] is not None:
                continue
            before = table[end - match[0]]
            if before is None:
                continue
            a = before[1]
            if a >= 0:
                ok = pairs.get(a * wide + match[1])
                if ok is None:
                    ok = self.compatible(a, match[1])
                if not ok:
                    continue
            table[end] = match
        return table

    def part_ids(self, part: str) -> list[int]:
        """Ids of a part whose characters all have a place in the table, or of one odd character."""
        if part[0] not in self.chars:
            return [self.of_byte[b] for b in part.encode()]
        table = self.last_tokens(part)
        at, ids = len(part), []
        while at:
            length, i = table[at]
            ids.extend([self.of_byte[b] for b in reversed(self.text_of[i].encode())] if i >= self.size else [i])
            at -= length
        ids.reverse()
        return ids

    def encode(self, text: str, keep: bool = True) -> bytes:
        """Ids of the whole text without begin and end, as little-endian 32-bit integers.

        ``keep`` false: its parts are not kept, as they will not come back.
        """
        if not text:
            return b""
        known, out = self.parts, []
        for part in self.cut.findall(BLANK + text.replace(" ", BLANK)):
            ids = known.get(part)
            if ids is None:
                ids = self.before.get(part) or pack(self.part_ids(part))
                if keep and len(part) <= PART:
                    if len(known) >= PARTS:
                        self.before, self.parts = known, {}
                        known = self.parts
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the blank that encoding puts first is taken off, odd bytes become U+FFFD."""
        out = self.out
        raw = b"".join([out[i] for i in ids.tolist()])
        first = next((i for i in ids.tolist() if i not in self.v.control), None)
        if first is not None and self.v.byte[first] < 0 and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_coder: tuple[object, Coder] | None = None


def coder(vocabulary: Vocabulary) -> Coder:
    """The worker's coder of a vocabulary; it keeps its tables between tasks."""
    global _coder
    key = (len(vocabulary.pieces), hash(tuple(vocabulary.pieces)))
    if _coder is None or _coder[0] != key:
        _coder = (key, Coder(vocabulary))
    return _coder[1]


def encode(docs: DataFrame, model: str, id_column: str = "doc_id", bounds: bool = True) -> DataFrame:
    """(id, ids, decoded) of every row: ids as an array of integers, decoded as text."""
    return _mapped(docs, model, id_column, bounds, "ids array<int>, decoded string", lambda ids, text: (
        pa.array([np.frombuffer(x, np.int32) for x in ids], pa.list_(pa.int32())), pa.array(text, pa.string())))


def digests(docs: DataFrame, model: str, id_column: str = "doc_id", bounds: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return _mapped(
        docs, model, id_column, bounds, "n_tokens long, ids_sha256 string, decoded_sha256 string",
        lambda ids, text: (
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in text], pa.string())))


def _mapped(docs, model, id_column, bounds, schema, made) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(load(model))  # a vocabulary file: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(shared.value)
        begin, end = (pack([i]) if bounds else b"" for i in (own.v.bos, own.v.eos))
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                ids = [begin + own.encode(t or "") + end for t in part.column(1).to_pylist()]
                text = [own.decode(np.frombuffer(x, _ID)) for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), *made(ids, text)], names)

    names = [id_column, *[x.split()[0] for x in schema.split(", ")]]
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(run, f"`{id_column}` {kind}, {schema}")
