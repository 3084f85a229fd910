"""Near duplicates, repeated bytes and benchmark passages against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitchlake.llm import decontaminate, embed_dedup, simhash, suffix_dedup
from pitchlake.llm.components import stars


def groups(n, pairs):
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_stars_on_chains_and_hubs(spark, docs):
    docs([])
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 90)] + [(i, i) for i in range(5)] + [(41, None)]
    rng.shuffle(pairs)
    got = {r.u: r.v for r in stars(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 50 for i in range(51, 90)}
    assert stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tree_search_finds_every_component():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 120))
        fp = rng.integers(0, 2**63, 5).astype(np.uint64)[rng.integers(0, 5, n)]
        for _ in range(int(rng.integers(0, 12))):
            m = rng.random(n) < 0.5
            fp[m] ^= np.uint64(1) << rng.integers(0, 64, m.sum()).astype(np.uint64)
        shard, fp = np.unique(np.stack([rng.integers(0, 4, n).astype(np.uint64), fp]), axis=1)
        near = (np.bitwise_count(fp[:, None] ^ fp[None]) <= 4) & (shard[:, None] == shard[None])
        want = simhash.joined(len(fp), *np.nonzero(near))
        assert np.array_equal(simhash.local_links(shard.astype(np.int64), fp), want)


def test_simhash_against_brute_force(docs, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 8)
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(200)) for _ in range(4)]
    texts = []
    for i in range(70):
        words = base[i % 4].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "x"
        texts.append(" ".join(words))
    texts += [None, "", "  \n", "one two", "ONE two", "A bÉ c d e", texts[0], texts[0]]
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, texts[0])]
    got = [r for r in simhash.near_duplicates(docs(rows, extra=True)).collect()]
    assert len(got) == len(rows)

    def fp(t):
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))

    prints = [fp(t) for t in texts]
    label = groups(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.fp % 2**64, r.component_id) == (prints[r.doc_id], label[r.doc_id])
    kept = simhash.representatives(docs(rows))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(label))
    assert kept.where("doc_id is null").count() == 1


def test_simhash_long_text_in_slices(monkeypatch):
    from pitchlake.llm import arrays

    text = b" ".join(b"w%d" % (i * i % 97) for i in range(500))
    whole = simhash.fingerprint(text)
    real = arrays.slices
    monkeypatch.setattr(arrays, "slices", lambda d, o: real(d, o, 11))
    assert simhash.fingerprint(text) == whole


def test_embeddings_against_brute_force(spark, docs, monkeypatch):
    docs([])
    for name, value in (("CELL", 20), ("BLOCK", 8)):
        monkeypatch.setattr(embed_dedup, name, value)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(12, 8))
    x = centre[rng.integers(0, 12, 150)] + rng.normal(size=(150, 8)) * 0.12
    rows = [(i, x[i].astype(np.float32).tolist(), int(i % 2)) for i in range(150)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, [2 * v for v in rows[0][1]], 0), (203, None, 0), (204, [0.0] * 8, 0),
             (205, [float("nan")] * 8, 0), (206, rows[0][1], None), (207, [None] + rows[0][1][1:], 0), (208, rows[0][1][:4], 0),
             (209, [], 0), (None, rows[0][1], 0), (201, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embed_dedup.near_duplicates(df).collect()
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    unit = [np.array(r[1], float) / np.linalg.norm(r[1]) for r in ok]
    pairs = [(a, b) for a in range(len(ok)) for b in range(len(ok)) if a != b and ok[a][2] == ok[b][2]
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    ids = sorted({r[0] for r in ok})
    label = groups(len(ids), [(ids.index(ok[a][0]), ids.index(ok[b][0])) for a, b in pairs])
    want = sorted((r[0], sum(a == k for a, _ in pairs), ids[label[ids.index(r[0])]]) for k, r in enumerate(ok))
    want += [(r[0], 0, r[0]) for r in rows if r not in ok and r[0] is not None]
    assert sorted(want) == sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def brute_windows(rows, size=50):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            first.setdefault(b[k:k + size], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if i is not None and first[b[k:k + size]] < i:
                gone[k:k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("piece", [256, 1 << 20])
def test_suffixes_against_brute_force(docs, monkeypatch, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "SEND", 3000)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(shared)[rng.randint(0, 20):])
        rows.append((i, " ".join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * 400), (103, "a" * 70), (104, rows[0][1]), (104, rows[1][1]), (105, rows[0][1]),
             (None, rows[0][1]), (106, shared[0][:49]), (107, shared[0][:50]), (108, shared[1] + shared[1])]
    rng.shuffle(rows)
    got = suffix_dedup.deduplicated(docs(rows, extra=True)).collect()
    assert brute_windows(rows) == sorted((tuple(r) for r in got), key=str)
    assert suffix_dedup.deduplicated(docs([])).count() == 0


def test_radix_groups_are_equal_windows():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(400 - 11)
    group = suffix_dedup.radix_groups(data, starts, 11)
    text = data.tobytes()
    for a in range(0, 389, 7):
        assert np.array_equal(group == group[a], [text[b:b + 11] == text[a:a + 11] for b in starts])


def plain_tiles(text, item, least):
    """Mark the longest unmarked match again and again, comparing every two places."""
    out, a, b = [], [False] * len(text), [False] * len(item)
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(text)):
                n = 0
                while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n >= least and (best is None or (-n, j, i) < best):
                    best = (-n, j, i)
        if best is None:
            return out
        n, j, i = -best[0], best[1], best[2]
        out.append((i, j, n))
        a[i:i + n] = [True] * n
        b[j:j + n] = [True] * n


def test_tiles_are_greedy_and_apart():
    p = np.array([0, 1, 2, 10, 11])
    q = np.array([5, 6, 7, 0, 1])
    # The seeds at 10 and 11 reach item word 5, which the longer tile has: five words stay.
    assert decontaminate.tiles(p, q) == [(0, 5, 7), (10, 0, 5)]
    assert decontaminate.tiles(np.array([0, 20]), np.array([0, 0])) == [(0, 0, 5)]  # the item's words are marked once


@pytest.mark.parametrize("pairs", [1 << 20, 7])
def test_tiles_equal_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    rng = random.Random(8)
    for _ in range(60):
        letters = rng.choice(["a", "ab", "abcd"])
        text, item = ([rng.choice(letters) for _ in range(rng.randint(0, n))] for n in (40, 25))
        import pyarrow as pa

        own = decontaminate.items([0], [" ".join(item)])
        got = [t for *_, t in decontaminate.matches(pa.array([None, " ".join(text)]), own)]
        want = plain_tiles(text, item, decontaminate.LEAST)
        assert got == ([want] if want else [])


def test_a_repeated_word_stays_in_bounds():
    import resource

    import pyarrow as pa

    own = decontaminate.items([0], ["word " * 1000])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (row, item, found), = decontaminate.matches(pa.array(["word " * 100_000]), own)
    assert (row, item, found) == (0, 0, [(0, 0, 1000)])
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000  # KB


def test_reordered_and_edited_passages_are_caught(spark, docs, monkeypatch):
    rng = random.Random(3)
    words = lambda n: [f"q{rng.randint(0, 10**6)}" for _ in range(n)]
    items = [words(40) for _ in range(6)]
    clean = [" ".join(words(120)) for _ in range(5)]
    swapped = items[1][20:] + words(9) + items[1][:20]
    rows = [(i, t) for i, t in enumerate(clean)] + [
        (10, " ".join(words(30) + items[0] + words(30))), (11, " ".join(swapped)), (12, ", ".join(items[2]).upper() + "!"),
        (13, " ".join(items[3][:10] + words(50))), (14, None), (15, ""), (16, " ".join(items[4] + items[5])),
        (None, " ".join(items[0])), (10, " ".join(items[0]))]
    bench = spark.createDataFrame(
        [(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (91, ""), (92, "a b c"), (93, " ".join(items[0]))],
        "item_id long, text string")
    want = sorted([(10, 0), (10, 0), (10, 93), (10, 93), (11, 1), (12, 2), (16, 4), (16, 5), (None, 0), (None, 93)], key=str)
    for size in (1_000_000, 45):  # in one slice of the benchmark, and in several
        monkeypatch.setattr(decontaminate, "SLICE_WORDS", size)
        df = docs(rows, extra=True)
        got = decontaminate.contaminated(df, bench).collect()
        assert sorted([(r.doc_id, r.item_id) for r in got], key=str) == want
        kept = decontaminate.clean(df, bench)
        assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 13, 14, 15] and kept.columns == df.columns
    assert decontaminate.contaminated(docs(rows), bench.limit(0)).count() == 0
    assert decontaminate.clean(docs([]), bench).count() == 0


def test_repeated_ids_with_different_texts_stay_apart(spark, docs):
    words = [f"w{i}" for i in range(400)]
    a, b, c = " ".join(words[:100]), " ".join(words[100:220]), " ".join(words[220:])
    rows = [(1, a), (1, b), (2, c), (2, c), (3, a), (None, a)]
    groups = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs(rows)).collect()}
    assert len(groups) == 5 and groups[None, next(f for i, f in groups if i is None)] is None
    kept = [sorted((r.doc_id, r.text, r.n_chars) for r in simhash.representatives(docs(rows, extra=True).repartition(n)).collect() if r.doc_id)
            for n in (1, 5)]
    assert kept[0] == kept[1] == [(1, a, len(a)), (1, b, len(b)), (2, c, len(c))]
    other = docs([(7, a, "xx"), (7, a, "aa"), (7, a, "mm")])  # one text, other columns differ: the same row stays
    assert len({simhash.representatives(other.repartition(n)).first().lang for n in (1, 2, 3)}) == 1


def test_repeated_vector_ids_stay_apart(spark, docs):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [0.01, 1.0], 0), (4, [-1.0, 0.0], 0), (4, [-1.0, 0.01], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.select("*", *[F.lit(1).alias(x) for x in ("node", "vec", "n", "u", "v", "least", "root", "home", "copies")])
    got = sorted(tuple(r)[:3] for r in embed_dedup.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (4, 1, 4)]
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0
