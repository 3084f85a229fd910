"""Personal data: a semi-Markov conditional random field over candidate spans.

Base spans are grammar: e-mail addresses, IPv4 addresses, card numbers that pass Luhn, phone
numbers after a plus. Around marks and digits a text is cut into regions of overlapping
candidates, which are runs of digit groups and address shapes in every boundary they may have.
A region's segmentations into candidates and single characters form a semi-Markov CRF:
features describe a whole span (its groups, digits, checks, marks and both neighbours), and
a dynamic programme over the bounded candidates picks boundaries and kinds together; a candidate
has at most 19 digits, and only boundaries of candidates are places of the programme, so its work
grows with the candidates. The weights are fitted in numpy by stochastic gradient ascent of
the likelihood on the regions of about ``MAX_ROWS`` texts, picked by hash and, beyond
``MAX_REGIONS`` regions, those of the smallest hash; they are labelled by the grammar. Regions the
grammar says nothing about and that have eight digits or more are left out as undecided.

The result is every base span, and each span of the best segmentation that has a posterior of
at least ``SURE`` and touches no base span.

Defined results: a null or empty text has no span; offsets count code points; rows, repeated or
with null ids, come out as they came in; extra columns are ignored by ``find`` and kept by
``masked``. With nothing to learn from only base spans are found.
"""

from __future__ import annotations

import ast
import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
#: Texts that the field learns from, about, and regions of these at most; both are picked by hash.
MAX_ROWS, MAX_REGIONS = 3000, 24_000
EPOCHS, RATE, DECAY = 4, 0.1, 1e-4
SURE = 0.95
#: Most digits in a candidate.
MOST = 19

_SOME = re.compile(r"[0-9@]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_RUN = re.compile(r"[+(]{0,2}[0-9]++(?:[ ().\-]{1,2}[0-9]++)*+")
_DIGITS = re.compile(r"[0-9]++")
_HOST = re.compile(r" ?[\w-]++(?:\.[\w-]++)*+")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the grammar, by kind and start."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            out.append((0, start, last))
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40 and 16 <= len(d := digits(m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Loose address shapes: a mark with a name before and a host after it, a blank allowed at each side.

    Names are walked back from the mark and never into the shape before, so a text is read once.
    """
    at, last = text.find("@"), 0
    while at >= 0:
        end = at - 1 if at - 1 > last and text[at - 1] == " " else at
        start = end
        while start > last and (text[start - 1] in ".%+-_" or text[start - 1].isalnum()):
            start -= 1
        host = _HOST.match(text, at + 1) if start < end else None
        if host:
            last = host.end()
            yield start, last
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all candidates, with every boundary a run of digit groups can have."""
    out = set()
    for start, end in _addresses(text):
        out.add((0, start, end))
        dot = text.rfind(".", start, end)
        if dot > text.find("@", start, end):
            out.add((0, start, dot))
    for m in _RUN.finditer(text):
        groups = [g.span() for g in _DIGITS.finditer(text, m.start(), m.end())]
        for i, (start, _) in enumerate(groups):
            n, lead, dots, reach = 0, start, 0, start
            while lead > m.start() and text[lead - 1] in "+(" and start - lead < 2:
                lead -= 1
            for k in range(i, min(i + MOST, len(groups))):
                a, end = groups[k]
                n += end - a
                if n > MOST:
                    break
                dots += text.count(".", reach, a)
                reach = a
                if n >= 13:
                    out.add((2, start, end))
                if n >= 4 and dots == 3:
                    out.add((1, start, end))
                if 7 <= n <= 15:
                    out.add((3, lead, end))
                    if lead < start:
                        out.add((3, start, end))
    return sorted(out, key=lambda c: (c[1], c[2], c[0]))


def regions(text: str) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(start, end, candidates) of runs of overlapping candidates."""
    group, end = [], -1
    for c in candidates(text):
        if group and c[1] >= end:
            yield group[0][1], end, group
            group, end = [], -1
        group.append(c)
        end = max(end, c[2])
    if group:
        yield group[0][1], end, group


#: Words that announce a kind.
CUES = re.compile(r"(?i)\b(?:(e-?mail|mail|contact)|(ip|host|server|addr\w*)|(card|visa|credit|karte|tarjeta|carte)"
                  r"|(phone|tel\w*|call|fax|mobile))\W{0,3}$")
FEATURES = 64
WIDTH = len(KINDS) * FEATURES


def features(text: str, c: tuple[int, int, int]) -> list[int]:
    """Indices of a whole span's features."""
    kind, start, end = c
    span = text[start:end]
    d = digits(span)
    parts = _DIGITS.findall(span)
    f = [0, 1 + min(len(d), 20), 22 + min(len(parts), 7)]
    before, after = text[start - 1:start], text[end:end + 1]
    f.append(30 + (0 if not before else 1 if before.isalpha() else 2 if before.isdigit() else 3 if before.isspace() else 4))
    f.append(35 + (0 if not after else 1 if after.isalpha() else 2 if after.isdigit() else 3 if after.isspace() else 4))
    f += [40 + k for k, there in enumerate((
        span[:1] == "+", "(" in span and ")" in span, span.count("(") != span.count(")"), "-" in span, " " in span,
        "." in span, span.isascii(), "@" in span and "." in span.rpartition("@")[2], luhn(d),
        kind == 1 and len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        kind == 2 and len(d) >= 16, kind == 3 and 10 <= len(d) <= 12 and len(parts) >= 3,
        before in "+(" and bool(before), after[:1] in "-.)" and text[end + 1:end + 2].isdigit())) if there]
    cue = CUES.search(text, max(0, start - 24), start)
    if cue:
        f.append(60 if cue.lastindex == kind + 1 else 61)
    return [kind * FEATURES + i for i in f]


def _plus(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


def sums(places: list[tuple[int, int]], score: list[float]) -> tuple[list[float], list[float], list[tuple[int, int]], list[int]]:
    """Log sums of all segmentations up to and from each boundary, the candidates' boundaries by
    number, and the best segmentation.

    Between boundaries lie single characters, which score zero, so only boundaries are places.
    """
    number = {p: k for k, p in enumerate(sorted({p for place in places for p in place}))}
    at = [(number[s], number[e]) for s, e in places]
    size = len(number)
    ending: list[list[int]] = [[] for _ in range(size)]
    starting: list[list[int]] = [[] for _ in range(size)]
    for i, (s, e) in enumerate(at):
        ending[e].append(i)
        starting[s].append(i)
    fore, best, back, rear = [0.0] * size, [0.0] * size, [-1] * size, [0.0] * size
    for e in range(1, size):
        f, top = fore[e - 1], best[e - 1]
        for i in ending[e]:
            s = at[i][0]
            f = _plus(f, fore[s] + score[i])
            if best[s] + score[i] > top:
                top, back[e] = best[s] + score[i], i
        fore[e], best[e] = f, top
    for s in range(size - 2, -1, -1):
        r = rear[s + 1]
        for i in starting[s]:
            r = _plus(r, rear[at[i][1]] + score[i])
        rear[s] = r
    chosen, e = [], size - 1
    while e > 0:
        if back[e] >= 0:
            chosen.append(back[e])
            e = at[back[e]][0]
        else:
            e -= 1
    return fore, rear, at, chosen


def lattice(text: str, start: int, end: int, group, weights: np.ndarray):
    """Posterior of each candidate, and the best segmentation."""
    score = [float(weights[features(text, c)].sum()) for c in group]
    fore, rear, at, chosen = sums([(c[1] - start, c[2] - start) for c in group], score)
    whole = fore[-1]
    return [math.exp(fore[s] + x + rear[e] - whole) for (s, e), x in zip(at, score)], chosen


def spans(text: str | None, weights: np.ndarray | None) -> tuple[list, list]:
    """Base spans, and all spans by kind and start."""
    if not text or not _SOME.search(text):
        return [], []
    base = base_spans(text)
    more = []
    if weights is not None:
        taken = sorted((s, e) for _, s, e in base)
        starts = [s for s, _ in taken]
        reach = list(np.maximum.accumulate([e for _, e in taken])) if taken else []
        for start, end, group in regions(text):
            at = int(np.searchsorted(starts, end)) - 1
            if at >= 0 and reach[at] > start and all(
                    (k := int(np.searchsorted(starts, c[2])) - 1) >= 0 and reach[k] > c[1] for c in group):
                continue  # every candidate touches a base span
            sure, chosen = lattice(text, start, end, group, weights)
            for i in chosen:
                kind, s, e = group[i]
                k = int(np.searchsorted(starts, e)) - 1
                if sure[i] >= SURE and not (k >= 0 and reach[k] > s):
                    more.append(group[i])
    return base, sorted(base + more)


def examples(text: str) -> Iterator[tuple[list[list[int]], list[tuple[int, int]], list[int]]]:
    """(features of candidates, their places in the region, indices of the right ones)."""
    base = sorted(base_spans(text), key=lambda b: (b[1], -b[2]))
    starts = [b[1] for b in base]
    longest = max((b[2] - b[1] for b in base), default=0)
    for start, end, group in regions(text):
        near = base[bisect.bisect_left(starts, start - longest):bisect.bisect_left(starts, end)]
        own = [b for b in near if b[2] > start]
        index = {c: i for i, c in enumerate(group)}
        gold, last = [], -1
        for b in own:
            if b in index and b[1] >= last:
                gold.append(index[b])
                last = b[2]
        if len(gold) != len(own) or (not own and len(digits(text[start:end])) >= 8):
            continue
        yield [features(text, c) for c in group], [(c[1] - start, c[2] - start) for c in group], gold


def fit(data: list, seed: int = 5) -> np.ndarray | None:
    """Weights that maximise the likelihood of the right segmentations."""
    if not data:
        return None
    rng = np.random.default_rng(seed)
    w = np.zeros(WIDTH)
    w[::FEATURES] = -2.0
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for k in rng.permutation(len(data)):
            feats, places, gold = data[k]
            score = [float(w[f].sum()) for f in feats]
            fore, rear, at, _ = sums(places, score)
            right = set(gold)
            for i, (s, e) in enumerate(at):
                step = (i in right) - math.exp(fore[s] + score[i] + rear[e] - fore[-1])
                if abs(step) > 1e-4:
                    w[feats[i]] += rate * (step - DECAY * w[feats[i]])
    return w


def train(docs: DataFrame, max_rows: int = MAX_ROWS, max_regions: int = MAX_REGIONS) -> np.ndarray | None:
    """Weights from all regions of about ``max_rows`` texts, picked by the hash of the text.

    Beyond ``max_regions`` regions those of the smallest hash (of text and place) are taken,
    so neither the order nor the partitions of the rows play a part.
    """
    some = docs.where(F.col("text").rlike("[0-9]{3}|@")).select("text")
    total = some.count()
    if not total:
        return None
    span = 1 << 24

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = [repr(x) for x in examples(text)]
                for at in range(0, len(got), 4096):
                    part = got[at:at + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([h] * len(part), pa.int64()), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.string())],
                        ["h", "i", "x"])

    picked = some.select("text", F.xxhash64("text").alias("h")).where(
        F.pmod("h", F.lit(span)) < int(span * min(1.0, max_rows / total)))
    regions_ = picked.mapInArrow(run, "h long, i long, x string")
    rows = regions_.orderBy(F.xxhash64("h", "i"), "x").limit(max_regions).collect()  # at most max_regions
    return fit([ast.literal_eval(r["x"]) for r in rows])


def _said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in found)


def find(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    counts = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            got = [spans(t, own) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 *[pa.array([sum(b[0] == k for b in base) for base, _ in got], pa.int64()) for k in range(4)],
                 pa.array([hashlib.sha256(_said(base).encode()).hexdigest() for base, _ in got], pa.string()),
                 pa.array([_said(every) for _, every in got], pa.string())],
                ["doc_id", *counts, "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(c + ' long' for c in counts)}, base_sha256 string, spans string")


def mask(text: str | None, weights: np.ndarray | None) -> str | None:
    """The text with each run of overlapping spans replaced by the names of its kinds."""
    found = spans(text, weights)[1]
    if not found:
        return text
    out, at = [], 0
    todo = sorted((s, e, k) for k, s, e in found)
    while todo:
        start, end, kinds = todo[0][0], todo[0][1], [todo[0][2]]
        todo = todo[1:]
        while todo and todo[0][0] < end:
            end = max(end, todo[0][1])
            kinds.append(todo[0][2])
            todo = todo[1:]
        out += [text[at:start], "[" + "/".join(KINDS[k].upper() for k in sorted(set(kinds))) + "]"]
        at = end
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """The same rows and columns with masked texts; n_chars, where there is one, follows."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            text = pa.array([mask(t, own) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), text)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
