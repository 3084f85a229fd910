"""Language identification, quality and language-model scoring."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import lang_id, lm_score, pieces, quality
from pitchlake.llm.queries import tokenizer

SYLLABLES = {"aa": "ka lo mi tu pe", "bb": "sch ung ein cht ver", "cc": "eau oux ais ont ille"}


def prose(rng, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture
def labelled(docs):
    rng = random.Random(4)
    rows = [(i, prose(rng, lang, 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    return docs(rows + [(1000, None, "aa"), (1001, "", None), (1002, "12 ?! 34", "bb"), (None, rows[0][1], "aa"),
                        (1, rows[1][1], "bb"), (1003, "Щука ЖУК юла " * 30, None)], extra=True)


def test_language_is_learnt_and_unknown_is_rejected(labelled):
    model = lang_id.train(labelled, F.col("doc_id") % 3 != 5)
    got = lang_id.predict(labelled, model).collect()
    lang = {r.doc_id: r.lang for r in labelled.collect()}
    assert len(got) == 126
    for r in got:
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id == 1003:
            assert r.rejected
        else:
            assert r.lang_pred == lang[r.doc_id] and not r.rejected and 0 <= r.score <= 1
    kept = lang_id.accepted(labelled, model)
    assert kept.columns == labelled.columns and kept.count() == 122


WORDS = {
    "en": "the of and to in is that it was for on are with as his they be at one have this from or had by hot word but what some",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas plus par sur mais nous comme ou si",
    "es": "el de que y a en un ser se no haber por con su para como estar tener le lo todo pero más hacer o poder decir este ir otro",
    "it": "il di che è e la non un per in sono mi ho lo ma ha si con cosa le ti ci questo come qui bene sì della gli anche perché",
    "fi": "ja on ei se että hän oli mutta kun niin ovat joka myös kuin sitä nyt jos vain tämä olla mitä minä hyvä kaikki sinä mukaan",
}


@pytest.mark.parametrize("wrong", [0.0, 0.2])
def test_language_rejects_latin_script_that_was_not_learnt_and_keeps_clean_rows(wrong):
    rng = random.Random(8)

    def text(lang, n=60):
        return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))

    learnt = ["en", "de", "fr", "es"]
    rows = [(rng.choice(learnt) if rng.random() < wrong else lang, text(lang)) for lang in learnt * 100]
    model = lang_id.fit([(lang, *f) for (lang, _), f in zip(rows, lang_id.features([t for _, t in rows]))])
    for lang in WORDS:
        for n in (12, 60, 300):
            rejected = lang_id.score(model, [text(lang, n) for _ in range(60)])[2]
            assert rejected.mean() > 0.9 if lang not in learnt else not rejected.any(), (lang, n)


def test_language_slices_lose_no_subword(monkeypatch):
    text = "Abc dé fgh " * 20
    whole = lang_id.features([text])[0]
    monkeypatch.setattr(lang_id, "SLICE", 7)
    part = lang_id.features([text])[0]
    assert np.array_equal(whole[0], part[0]) and np.array_equal(whole[1], part[1])


def test_language_without_labels(docs):
    df = docs([(1, "abc")])
    assert lang_id.train(df) is None
    assert lang_id.predict(df, None).collect()[0].lang_pred == "und"
    assert lang_id.predict(df.limit(0), None).count() == 0


def test_quality_separates_and_defines_odd_rows(spark, docs):
    rng = random.Random(5)
    rows = [(i, prose(rng, "aa", 30) + (" $$ !!" * 4 if i % 3 == 0 else ".")) for i in range(240)]
    df = docs(rows + [(900, None), (901, ""), (None, "ka lo")], extra=True)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)] + [(1, 1, 0), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(df, labels, F.col("doc_id") < 120)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert len(got) == 243 and got[900] == got[901]
    held = range(120, 240)
    assert np.mean([(got[i] >= 0.5) == (i % 3 > 0) for i in held]) > 0.95
    none = quality.train(df, labels.limit(0))
    assert {r.score for r in quality.score(df, none).collect()} == {0.5}


def test_quality_features_against_counting():
    import pyarrow as pa

    from pitchlake.llm import arrays

    text, at, x = quality.features(*arrays.flat(pa.array(["a b a", None, "a"])))
    assert np.bincount(text, minlength=3).tolist() == [4, 0, 1]  # a, b, a b, b a; nothing; a
    assert np.allclose([(x[text == t] ** 2).sum() for t in (0, 2)], 1)


def test_gradients():
    rng = np.random.default_rng(0)
    classes = np.arange(20) + 10 * (np.arange(20) > 9)  # two groups, one with a gap
    w = {k: v.astype(np.float64) for k, v in lm_score.start(classes, 20).items()}
    ids, target = rng.integers(0, 20, (3, 9)), classes[rng.integers(0, 20, (3, 9))]
    target[0, -2:] = -1
    g = lm_score.gradient(w, ids, target)[1]
    for k in w:
        at = (ids[0, 0], 3) if k == "emb" else (1,) * w[k].ndim
        w[k][at] += 1e-5
        up = lm_score.gradient(w, ids, target)[0]
        w[k][at] -= 2e-5
        down = lm_score.gradient(w, ids, target)[0]
        w[k][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-4, k


def test_each_id_is_scored_once_with_its_overlap():
    rng = np.random.default_rng(3)
    classes, share, slot = lm_score.class_table(rng.integers(0, 50, 300).astype(float))
    w = lm_score.start(classes)
    n = [0, 1, lm_score.WINDOW, lm_score.WINDOW + 1, 3 * lm_score.WINDOW]
    stream, offsets = rng.integers(0, 300, sum(n)), np.concatenate([[0], np.cumsum(n)])
    got = lm_score.id_scores(w, classes, share, slot, stream, offsets, 1)
    back = lm_score.WINDOW - lm_score.STRIDE
    for t in range(len(n)):
        own = stream[offsets[t]:offsets[t + 1]]
        for i in range(n[t]):
            start = 0 if i < lm_score.WINDOW else (i - back) // lm_score.STRIDE * lm_score.STRIDE
            before = np.concatenate([[1], own])[start:i + 1]
            h = lm_score.forward(w, slot[before][None])[0][0, -1]
            group, member = divmod(int(classes[own[i]]), lm_score.MEMBERS)
            z, deep = h @ w["out"] + w["bias"], h @ w["deep"][group] + w["deep_bias"][group]
            want = z[group] - np.log(np.exp(z).sum()) + deep[member] - np.log(np.exp(deep).sum()) + share[own[i]]
            assert abs(want - got[offsets[t] + i]) < 1e-3


def test_scores_and_base_against_counting(docs, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 20)
    monkeypatch.setattr(lm_score, "SEND", 2000)
    rng = random.Random(6)
    rows = [(i, prose(rng, "aa", rng.randint(1, 60))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "KA loé \n zzz"), (103, rows[0][1]), (103, rows[0][1])]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    got = lm_score.score(docs(rows, extra=True), held, tokenizer()).collect()
    is_held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    count = {}
    for i, x in tokens:
        if not is_held[i]:
            for w in x:
                count[w] = count.get(w, 0) + 1
    total = sum(count.values())
    want = sorted((i, is_held[i], len(x), sum(w in count for w in x), total, round(sum(
        np.log10((count.get(w, 0) + 0.5) / (total + 0.5 * (len(count) + 1))) for w in x), 6)) for i, x in tokens)
    assert want == sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 for r in got)


def test_pieces_equal_the_library(docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    m = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab theing▁  \n\té\U0001f642ＡN.,=\x00中あﬁ") for _ in range(rng.randint(0, 40)))
             for _ in range(1500)]
    texts += [None, "", " ", "  ", " " * 999, "=" * 501, "ab" * 3000, "\n" * 40, "<s>", "<0x41>", "▁"]
    df = docs([(i, t) for i, t in enumerate(texts)] + [(None, "a"), (3, texts[3])], extra=True)
    got = pieces.encode(df, tokenizer()).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = m.encode("a" if r.doc_id is None else texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.ids == want and r.decoded == m.decode(want)


def test_pieces_tables_may_overflow(monkeypatch):
    monkeypatch.setattr(pieces, "PARTS", 3)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    c = pieces.Coder(pieces.load(tokenizer()))
    text = "some words here and some words there and more"
    assert c.encode(text) == c.encode(text)
    assert c.decode(np.frombuffer(c.encode(text), "<u4")) == text


def test_scores_of_no_rows_and_of_no_training_text(docs, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 2)
    held = F.col("doc_id") > 0
    assert lm_score.score(docs([]), held, tokenizer()).count() == 0
    (r,) = lm_score.score(docs([(5, "a b")]), held, tokenizer()).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and r.score < 0


def test_hidden_states_of_scoring_equal_those_of_training():
    rng = np.random.default_rng(8)
    classes, _, slot = lm_score.class_table(rng.integers(0, 50, 300).astype(float))
    w = lm_score.start(classes)
    ids = rng.integers(0, 200, (5, 17))
    assert np.abs(lm_score.hidden(w, ids) - lm_score.forward(w, ids)[0]).max() < 1e-5


def test_score_recomputed_word_by_word(docs, monkeypatch):
    """Every token's probability, mixed with its share, one window and one id at a time."""
    kept = {}

    def untrained(w, windows, classes, slot):
        rng = np.random.default_rng(1)
        kept["w"] = {k: (x + rng.normal(0, 0.2, x.shape)).astype(np.float32) for k, x in w.items()}
        return kept["w"]

    monkeypatch.setattr(lm_score, "fit", untrained)
    rng = random.Random(9)
    rows = [(i, prose(rng, "aa", rng.randint(0, 70))) for i in range(25)] + [(90, "x▁y z " * 9), (91, None), (92, "same same"), (93, "same same")]
    held = F.col("doc_id") % 5 == 1
    got = {r.doc_id: r.score for r in lm_score.score(docs(rows).repartition(3), held, tokenizer()).collect()}
    coder = pieces.Coder(pieces.load(tokenizer()))
    v = coder.v
    lower = {i: [w.decode() for w in (t or "").encode().lower().split()] for i, t in rows}
    ids_of = {w: np.frombuffer(coder.encode(w, keep=False), "<u4").tolist() for x in lower.values() for w in x}
    train = [i for i, _ in rows if i % 5 != 1]
    count, sub = {}, np.zeros(len(v.pieces))
    for i in train:
        for w in lower[i]:
            count[w] = count.get(w, 0) + 1
            np.add.at(sub, ids_of[w], 1)
    sub[v.eos] += len(train)
    total = sum(count.values()) + len(train)
    classes, share, slot = lm_score.class_table(sub)
    w_ = kept["w"]
    back = lm_score.WINDOW - lm_score.STRIDE
    for i, words in lower.items():
        stream = [x for w in words for x in ids_of[w]] + [v.eos]
        p = []
        for k, target in enumerate(stream):
            start = 0 if k < lm_score.WINDOW else (k - back) // lm_score.STRIDE * lm_score.STRIDE
            assert k < lm_score.WINDOW or k - start >= lm_score.WINDOW / 2  # half a window of context
            before = np.array([v.bos, *stream])[start:k + 1]
            h = lm_score.forward(w_, slot[before][None])[0][0, -1]
            group, member = divmod(int(classes[target]), lm_score.MEMBERS)
            p.append(lm_score.log_softmax(h @ w_["out"] + w_["bias"])[group]
                     + lm_score.log_softmax(h @ w_["deep"][group] + w_["deep_bias"][group])[member] + share[target])
        at, whole = 0, 0.0
        for size, n in [(len(ids_of[w]), count.get(w, 0)) for w in words] + [(1, len(train))]:
            own = np.exp(np.float64(sum(p[at:at + size])))
            whole += np.log10((1 - lm_score.MIXED) * own + lm_score.MIXED * n / total)
            at += size
        assert abs(got[i] - whole) < 1e-3 * max(1, len(stream) / 10), i


def test_every_id_of_every_training_text_is_learnt_from_once(docs, monkeypatch):
    kept = {}

    def fit(w, windows, classes, slot):
        kept["rows"] = windows.collect()
        return w

    monkeypatch.setattr(lm_score, "fit", fit)
    monkeypatch.setattr(lm_score, "SEND", 2000)
    rng = random.Random(3)
    rows = [(i, prose(rng, "aa", n)) for i, n in enumerate([0, 1, 30, 47, 48, 49, 400, 900, 20, 1200])] + [(90, None), (92, "same same"), (93, "same same")]
    assert lm_score.score(docs(rows).repartition(2), F.col("doc_id") % 5 == 1, tokenizer()).count() == len(rows)
    coder = pieces.Coder(pieces.load(tokenizer()))
    got = {}
    for r in sorted(kept["rows"], key=lambda r: (r.doc_id, r.nth)):
        ids = np.frombuffer(r.ids, "<i4")
        before = got.setdefault(r.doc_id, [coder.v.bos])
        assert ids[0] == before[-1] and len(ids) == lm_score.WINDOW + 1
        before += [x for x in ids[1:].tolist() if x >= 0]
    want = {i: [coder.v.bos, *(x for w in (t or "").encode().lower().split() for x in np.frombuffer(coder.encode(w.decode(), keep=False), "<u4").tolist()),
                coder.v.eos] for i, t in rows if i % 5 != 1}
    assert got == want


def test_attention_gains_on_held_out_texts_over_the_model_without(monkeypatch):
    """An id that follows from the one three before: no model of the last id alone can know it."""
    rng = np.random.default_rng(4)
    n = 60
    classes = np.arange(n)
    seqs = np.empty((500, lm_score.WINDOW + 1), np.int64)
    seqs[:, :3] = rng.integers(0, 12, (500, 3))
    for k in range(3, lm_score.WINDOW + 1):
        seqs[:, k] = (seqs[:, k - 3] + 5) % 12
    loss = {}
    for name, mask in (("with", lm_score._MASK), ("without", np.where(np.eye(lm_score.WINDOW) > 0, 0, -1e9).astype(np.float32))):
        monkeypatch.setattr(lm_score, "_MASK", mask)
        w = lm_score.start(classes, n)
        lm_score.adam(w, seqs[:400], classes, np.arange(n), 30, 0.02, 3)
        loss[name] = lm_score.gradient(w, seqs[400:, :-1], seqs[400:, 1:])[0]
    assert loss["with"] < loss["without"] - 0.5


def test_every_training_text_is_learnt_from_and_the_share_grows(docs, spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, "aa", rng.choice([0, 1, 30, 900]))) for i in range(80)]
    vocabulary = pieces.load(tokenizer())
    shared = spark.sparkContext.broadcast((vocabulary, open(tokenizer(), "rb").read()))
    counts = []
    for part in (rows[:40], rows):
        counts.append(lm_score.training_windows(docs(part), shared).count())
        assert counts[-1] >= len(part)
    assert counts[1] > 1.5 * counts[0]
    windows = lm_score.training_windows(docs(rows), shared)
    classes, _, slot = lm_score.class_table(np.ones(len(vocabulary.pieces)))
    lm = lm_score.fit(lm_score.start(classes), windows, classes, slot)
    assert all(np.isfinite(x).all() for x in lm.values())


def test_large_scores_of_attention_are_not_cut():
    """Relative to their largest, in training and in scoring alike."""
    rng = np.random.default_rng(2)
    classes, _, slot = lm_score.class_table(rng.integers(0, 50, 300).astype(float))
    w = {k: v.astype(np.float64) for k, v in lm_score.start(classes).items()}
    w["q"] *= 400
    ids = rng.integers(0, 200, (4, 21))
    x = w["emb"][ids] + w["place"][:21]
    a = (x @ w["q"]) @ (x @ w["k"]).transpose(0, 2, 1) * lm_score.DIM ** -0.5 + np.triu(np.full((21, 21), -1e9), 1)
    assert a.max() > 100
    h = x + np.exp(lm_score.log_softmax(a)) @ (x @ w["v"]) @ w["o"]
    want = h + np.maximum(h @ w["up"], 0) @ w["down"]
    assert np.abs(lm_score.forward(w, ids)[0] - want).max() < 1e-5
    assert np.abs(lm_score.hidden(w, ids) - want).max() < 1e-5
    assert np.abs(lm_score.hidden(w, ids, 9) - want[:, 9:]).max() < 1e-5


def test_windows_leave_no_files_once_learnt(docs, monkeypatch):
    import os

    monkeypatch.setattr(lm_score, "STEPS", 2)
    paths, folder = [], lm_score.scratch
    monkeypatch.setattr(lm_score, "scratch", lambda spark, purpose: paths.append(folder(spark, purpose)) or paths[-1])
    rng = random.Random(4)
    out = lm_score.score(docs([(i, prose(rng, "aa", 50)) for i in range(20)]), F.col("doc_id") % 5 == 1, tokenizer())
    at = {p.removeprefix("file://"): os.path.basename(p).split("-")[0] for p in paths}
    assert sorted(at.values()) == ["blocks", "windows", "words"]
    assert [os.path.exists(p) for p, name in at.items() if name == "windows"] == [False]
    assert out.count() == 20


def test_words_that_are_no_text_are_one_word_where_they_read_alike():
    import pyarrow as pa

    words, place = lm_score._distinct(pa.array([b"a", b"\xff", b"a", b"\xfe", b"b"], pa.large_binary()))
    assert words.to_pylist() == ["a", "�", "b"] and place.tolist() == [0, 1, 0, 1, 2]
