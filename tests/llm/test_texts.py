"""Page texts, personal data and the pipeline."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import html_text, pii


def plain_base(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 16 <= len(d := pii.digits(m.group())) <= 19 and pii.luhn(d):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(pii.digits(m.group())) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for k in range(20000):
        t = "".join(rng.choice(("0123456789.@a-+ ()bñ1.", "12.@a--.", "0123456789 -")[k % 3]) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_base(t), t
    assert pii.base_spans("1" * 50000 + "@" * 50000) == plain_base("1" * 200 + "@" * 200)


@pytest.fixture
def private(docs):
    rng = random.Random(8)
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = "4" + digit(14)
        return next(body + c for c in "0123456789" if pii.luhn(body + c))

    make = [lambda: f"a{digit(2)}@mail{digit(1)}.example.com", lambda: f"{rng.randint(1, 255)}.{rng.randint(1, 99)}.1.{rng.randint(1, 99)}",
            card, lambda: f"+1 ({digit(3)}) 555-{digit(4)}"]
    rows = [(i, "the text has " + rng.choice(make)() + " in it and " + digit(rng.randint(1, 5)) + " more") for i in range(200)]
    return docs(rows + [(500, None), (501, ""), (502, "nothing here"), (503, "x +1 (269) 555-3296 " + card() + " y"), (0, rows[0][1])],
                extra=True)


def test_field_adds_spans_and_keeps_base_ones(private):
    weights = pii.train(private)
    text = {r.doc_id: r.text or "" for r in private.collect()}
    got = pii.find(private, weights).collect()
    assert len(got) == 205
    for r in got:
        base = plain_base(text[r.doc_id])
        said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == k for b in base) for k in range(4))
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
    neighbours = next(r.spans for r in got if r.doc_id == 503)
    assert "card:20:36" in neighbours and "phone:2:19" in neighbours  # the patterns see neither
    masked = {r.doc_id: r for r in pii.masked(private, weights).collect()}
    assert masked[503].text == "x [PHONE] [CARD] y" and masked[503].n_chars == 18
    assert masked[500].text is None and masked[502].text == "nothing here"
    assert pii.masked(private, weights).columns == private.columns


def test_field_with_nothing_to_learn_from(docs):
    df = docs([(1, "plain words")])
    assert pii.train(df) is None
    assert pii.find(df.limit(0), None).count() == 0


def test_segmentation_is_the_best_of_all():
    import itertools

    import numpy as np

    text = "+1 22 333 4444"
    (start, end, group), = pii.regions(text)
    w = np.random.default_rng(2).normal(size=pii.WIDTH)
    sure, chosen = pii.lattice(text, start, end, group, w)
    score = [w[pii.features(text, c)].sum() for c in group]
    every = [()]
    for n in range(1, 4):
        every += [c for c in itertools.combinations(range(len(group)), n)
                  if all(group[a][2] <= group[b][1] or group[b][2] <= group[a][1] for a, b in itertools.combinations(c, 2))]
    total = np.array([sum(score[i] for i in c) for c in every])
    assert sorted(chosen) == sorted(every[int(total.argmax())])
    weight = np.exp(total) / np.exp(total).sum()
    for i in range(len(group)):
        assert abs(sure[i] - sum(p for c, p in zip(every, weight) if i in c)) < 1e-9


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<article>a &amp; b&nbsp;&#x41;<br>c</article>", "a & b A c"),
    ("<nav>menu<article><p>x<p>y</article>", "x\ny"),
    ("<p>out</p><article><h1>T</h1><p><b>one  two<br><p>three<aside>no</aside><form>no</form></article><footer>f", "T\none two\nthree"),
    ("<main><p>m</p></main><p>out</p>", "m"), ("<article>a<!-- <p>no --><script>if(a<b)</script><style>p{}</style>b</article>", "ab"),
    ("<article><p>p</p><div class='share-bar'>no</div></article><div id=comments><article class=comment>no</article></div>", "p"),
    ("<article>1 < 2 & 3</article>", "1 < 2 & 3"), ("<title>t</title><div class=ad>no</div><article>yes", "yes"),
])
def test_marked_up_pages(page, want):
    assert html_text.read(page)[0] == want


def test_open_pages_lose_what_their_host_repeats(spark, docs):
    docs([])
    rng = random.Random(4)
    body = lambda: " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(30))
    menu = "<p>Home News Sport Weather Shop Travel More Search Contact</p>"
    own = [body() for _ in range(12)]
    rows = [(i, f"http://a.example/{i}", f"{menu}<p>{own[i]}</p><p>All rights reserved by the people of this very site</p>") for i in range(12)]
    rows += [(20, "http://b.example/1", f"{menu}<p>{own[0]}</p>"), (21, None, "<p>only</p>"), (22, "http://a.example/x", None),
             (0, rows[0][1], rows[0][2]), (None, "http://a.example/z", "<article>in</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.main_text(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and [text[i] for i in range(12)] == own
    assert text[20] == f"Home News Sport Weather Shop Travel More Search Contact\n{own[0]}"  # one page of its host
    assert (text[21], text[22], text[None]) == ("only", "", "in")
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("shard", [250, 7])
def test_all_blocks_of_a_host_are_evidence_and_articles_stay_whole(spark, docs, monkeypatch, shard):
    docs([])
    monkeypatch.setattr(html_text, "SHARD", shard)
    rng = random.Random(5)
    body = lambda: " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(30))
    menu = "Home News Sport Weather Shop Travel More Search Contact"
    rare = "This page was moved here from the old site of ours"
    same = body()
    own = [body() for _ in range(60)]
    rows = [(i, f"http://a.example/{i}", f"<nav>{menu}</nav><article><p>{own[i]}</p><p>{same}</p></article>") for i in range(40)]
    rows += [(i, f"http://a.example/{i}", f"<p>{menu}</p><p>{own[i]}</p>" + f"<p>{rare}</p>" * (i < 43)) for i in range(40, 60)]
    rows += [(60, "http://a.example/60", f"<p>{menu}</p>"), (61, "http://b.example/", f"<p>{menu}</p>"), (62, None, None)]
    rows += [(63 + i, f"http://c.example/{i}", f"<nav>{menu}</nav><article>{own[i]}</article>") for i in range(3)]
    rows += [(66, "http://c.example/3", f"<p>{menu}</p><p>{own[3]}</p>")]  # the only page of its host that marks nothing
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert len(text) == 67 and [text[63 + i] for i in range(4)] == own[:4]
    for i in range(60):
        assert text[i] == (f"{own[i]}\n{same}" if i < 40 else own[i]), i
    assert (text[60], text[61], text[62]) == ("", menu, "")


def test_suffix_groups():
    import numpy as np

    tokens = np.array([1, 2, 3, 1, 2, 3, 1, 2])
    group = html_text.suffix_groups(tokens, np.full(8, 8), 3)
    assert group[0] == group[3] >= 0 and group[1] == group[4] and len(set(group[:3])) == 3 and (group[6:] == -1).all()


def test_pipeline_against_its_parts(spark, tmp_path, docs):
    import os

    import corpus_pipeline

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    docs([])
    source = spark.read.parquet(f"{sf}/documents.parquet")
    kept, before = source, source
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, kept = kept, stage(spark, kept, sf)
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == source.columns, name
    out = {r.doc_id: r for r in kept.collect()}
    text = {r.doc_id: r.text for r in before.collect()}
    assert set(out) == set(text) and all(out[i].decoded == text[i] for i in out)
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == set(out)
    bench = [re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for t in text.values():
        words = " ".join(re.findall(r"[^\W_]+", t.lower()))
        assert not any(" ".join(b) in words for b in bench)
        assert not [s for s in plain_base(t) if s[0] in (0, 2, 3)]


def test_every_region_counts_and_long_tables_fit_fast(docs):
    import time

    numbers = " ".join(str(10 ** 6 + 37 * i) for i in range(13_000))  # some 100 KB
    text = "host 10.1.2.3 " + numbers
    start = time.time()
    found = list(pii.examples(text))
    assert pii.fit(found) is not None and time.time() - start < 20
    # The right segmentation is found among all, however many groups a candidate has.
    card = "4 5 3 2 0 1 5 1 1 2 8 3 0 3 6 6"
    assert (2, 0, len(card)) in pii.candidates(card)
    name = "a" * 60 + "@example.org"
    assert (0, 0, len(name)) in pii.candidates(name)


def test_weights_do_not_depend_on_partitions(docs):
    rows = [(i, f"mail user{i}@example.com host 10.0.0.{i % 250} call +49 30 {1234560 + i} card 4532015112830366 and {i} {i + 1}") for i in range(60)]
    one, many = (pii.train(docs(rows).repartition(n), max_regions=50) for n in (1, 9))
    assert one is not None and np.array_equal(one, many)


def test_sums_equal_all_segmentations():
    places = [(0, 3), (2, 5), (3, 5), (6, 9), (0, 9)]
    score = [0.5, 1.5, -0.3, 0.2, 1.0]
    fore, rear, at, chosen = pii.sums(places, score)
    sets = [c for k in range(len(places) + 1) for c in itertools.combinations(range(len(places)), k)
            if all(places[i][1] <= places[j][0] or places[j][1] <= places[i][0] for i, j in itertools.combinations(c, 2))]
    values = [sum(score[i] for i in c) for c in sets]
    assert abs(fore[-1] - np.log(np.exp(values).sum())) < 1e-12 and abs(rear[0] - fore[-1]) < 1e-12
    assert sorted(chosen) == sorted(sets[int(np.argmax(values))])


@pytest.mark.parametrize("page,want", [
    ("<main><h1>T</h1><p>body text here</p><article class=card>teaser</article></main>", "T\nbody text here\nteaser"),
    ("<article><div class='post ad-free'><p>kept</p></div></article>", "kept"),
    ("<article><section class='related-work'><h2>Related work</h2><p>text</p></section></article>", "Related work\ntext"),
    ("<article><p>press <button>Start</button> to begin</p><button>Subscribe</button></article>", "press Start to begin"),
    ("<article><p>a<svg><text>no</text></svg> b</p><div class='site-footer'>no</div><div class='cookie-notice'>no</div></article>", "a b"),
    ("<article><p>one <select><option>x</option></select> two</p><div class='comment-list'>no</div></article>", "one two"),
    ("<main><p>small</p><article>the article holds the bulk of it</article></main>", "the article holds the bulk of it"),
])
def test_markup_drops_nothing_else(page, want):
    assert html_text.read(page)[0] == want


def test_the_host_decides_where_the_markup_is_in_doubt(spark, docs):
    docs([])
    rng = random.Random(6)
    body = lambda: " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(30))
    same = "Read more of our stories in the archive of this fine paper today"
    rows, want = [], {}
    for i in range(6):
        own, alert = body(), body()
        rows.append((i, f"http://a.example/{i}", f"<article><p>{own}</p><p class='alert'>{alert}</p><div class=related>{same}</div></article>"))
        want[i] = f"{own}\n{alert}"
    rows.append((9, "http://b.example/", f"<article><p>x</p><div class=related>{same}</div></article>"))  # once on its host
    want[9] = f"x\n{same}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.select("*", *[F.lit(1).alias(n) for n in (
        "host", "parts", "keys", "shard", "digest", "zones", "shards", "text")])
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert got == want
    found = html_text.blocks(rows[0][2])
    assert html_text.decided(found, [False, False, True]) and not html_text.decided(found, [True, False, False])
    assert html_text.main_text(df.limit(0)).count() == 0


def test_cover_equals_brute_force():
    """Groups of the array, their pages and the covered blocks, against all windows one by one."""
    rng = random.Random(2)
    for _ in range(4):
        pages = [[" ".join(rng.choice("ab") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(0, 3))] for _ in range(7)]
        rows = [{"parts": p, "zones": [0] * len(p), "digest": i, "shards": 1} for i, p in enumerate(pages)]
        shard = html_text.Shard(rows)
        keys, count = shard.groups()
        got = shard.texts(keys[count >= html_text.PAGES])
        tokens = [" ".join(p).split() for p in pages]
        d = html_text.DEPTH
        windows = [{tuple(t[k:k + d]) for k in range(len(t) - d + 1)} for t in tokens]
        often = {w for s in windows for w in s if sum(w in o for o in windows) >= html_text.PAGES}
        for i, (parts, t) in enumerate(zip(pages, tokens)):
            hit = {j for k in range(len(t) - d + 1) if tuple(t[k:k + d]) in often for j in range(k, k + d)}
            at, kept = 0, []
            for part in parts:
                n = len(part.split())
                if sum(j in hit for j in range(at, at + n)) < html_text.COVER * n:
                    kept.append(part)
                at += n
            assert got[i] == "\n".join(kept)


@pytest.mark.parametrize("bits", [2, 26])
def test_shards_of_a_host_ask_by_leading_bits_and_its_pages_are_shuffled_once(spark, docs, monkeypatch, bits):
    docs([])
    rng = random.Random(8)
    word = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    lines = [word(rng.randint(1, 14)) for _ in range(40)]
    rows = [(i, "http://a.example/", "".join(f"<p>{rng.choice(lines)}</p>" for _ in range(rng.randint(0, 4)))) for i in range(80)]
    df = spark.createDataFrame(rows + [(99, "http://a.example/", rows[0][2])], "page_id long, url string, html string")
    want = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert want != {r[0]: "\n".join(t for _, t in html_text.blocks(r[2])) for r in rows} and want[99] == want[0]
    monkeypatch.setattr(html_text, "SHARD", 5)
    monkeypatch.setattr(html_text, "BITS", bits)  # few bits: keys that only begin alike are told apart by the rest
    out = html_text.main_text(df)
    assert {r.page_id: r.text for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("MapInArrow cut") == 2 and plan.count("ReusedExchange") >= 2  # hosts of one shard, of several


def test_gaps_give_their_values_back():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        values = rng.integers(0, 1 << 32, n).astype(np.uint64)
        assert html_text._values(html_text._gaps(values)).tolist() == sorted(set(values.tolist()))
    values = np.arange(0, 1 << 16, 4, dtype=np.uint64)
    assert len(html_text._gaps(values)) < len(values)  # keys went out in ten bytes each
