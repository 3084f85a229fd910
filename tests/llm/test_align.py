"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from pitchlake.llm import align, queries
from pitchlake.llm.queries import BYTES, tokenizer

TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "the the the the", " leading and trailing ", "two  blanks   three",
    "tabs\tand\nlines\r\n\n end", "Größe, naïve café — señor 東京 テスト", "😀 emoji 👩‍👩‍👧 family", "<s> </s> <|endoftext|> <unk> <0x41>",
    "a b  c​d ﻿e", "x" * 500, "1234567 12.5 $9,99", "don't we'll I'm", "has ▁ inside", "zero\x00byte", "",
    None, " ", "  ", "\n", "a", "supercalifragilistic" * 40, "The quick brown fox jumps over the lazy dog.",
]


def plain(texts):
    """Rows of the contract by the two libraries, one document at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(tokenizer(BYTES))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    letter = align.byte_of_letter()
    names = {i: t for t, i in json.load(open(tokenizer(BYTES)))["model"]["vocab"].items()}

    def spans(tokens):
        at, out = 0, []
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        ab = [bytes(letter[c] for c in names[i]) for i in a]
        bb = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        if b"".join(ab) != whole or b"".join(bb) != whole:
            docs.append(None)
            continue
        sa, sb = spans(ab), spans(bb)
        links, low = [], 0
        for x, (p, q) in zip(a, sa):
            while sb[low][1] <= p:
                low += 1
            for y, (r, s) in zip(b[low:low + 400], sb[low:low + 400]):
                if r >= q:
                    break
                if p < s:
                    links.append((x, y))
            else:
                assert low + 400 >= len(sb)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, start = [], 0
        for cut in cuts:
            groups.append((",".join(str(x) for x, (p, _) in zip(a, sa) if start <= p < cut),
                           ",".join(str(y) for y, (p, _) in zip(b, sb) if start <= p < cut)))
            start = cut
        docs.append((a, b, groups, links))
    count = {}
    for d in docs:
        for pair in set(d[3]) if d else ():
            count[pair] = count.get(pair, 0) + 1
    high = {}
    for (x, _), n in count.items():
        high[x] = max(high.get(x, 0), n)
    out = []
    for d in docs:
        if not d:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        out.append((len(a), len(b), len(groups), len(links), sum(count[p] == high[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bound", [1_000_000, 30])
def test_alignment_equals_plain_loops(docs, bound, monkeypatch):
    monkeypatch.setattr(align, "PAIRS", bound)  # 30: many blocks, their tables are added up
    monkeypatch.setattr(align, "TEXTS", 3)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = align.align(docs(rows, extra=True).repartition(3), tokenizer(BYTES), tokenizer())
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == dict(enumerate(plain(TEXTS)))


def test_repeated_and_null_ids_and_clashing_names(docs):
    df = docs([(1, "one two"), (1, "one two"), (None, "one three")])
    df = df.select("*", *[F.lit(3).alias(c) for c in ("block", "id", "links", "numbers", "a", "b", "docs", "n", "best", "n_a")])
    got = align.align(df, tokenizer(BYTES), tokenizer()).collect()
    want = plain(["one two", "one two", "one three"])
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, *want[0]), (1, *want[1]), (None, *want[2])], key=str)


def test_no_rows(docs):
    assert align.align(docs([]), tokenizer(BYTES), tokenizer()).collect() == []


def test_anchors_only_where_both_ends_meet():
    tokens = align.Tokens(align.load(tokenizer(BYTES), tokenizer()))
    windows = align.Windows(tokens)
    (a, b), = tokens.ids(["some words, unbelievable ones"])
    zero = [0]
    at, bt = windows.anchors(a, b, zero, zero)
    ends = lambda size, ids, i: int(size[ids[:i]].sum())
    assert len(at) == 4  # one for each word
    for i, j in zip(at, bt):
        assert ends(tokens.a_size, a, i) == ends(tokens.b_size, b, j)
    first = windows.of([(a, b)])[0].tolist()
    made = len(windows.groups)
    again, sizes = windows.of([(a, b), (a[:0], b[:0]), (a, b)])
    assert again.tolist() == 2 * first and sizes.tolist() == [4, 0, 4] and len(windows.groups) == made  # kept by ids


def test_registered_query(spark, docs):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_token_alignment"](spark, sf).collect()}
    assert got == dict(zip([r[0] for r in rows], plain([r[1] for r in rows])))
