"""Main text of web pages: a suffix array over each host's pages, checked against the markup.

A page is cut into blocks of text in one pass over its tags. The token streams of all blocks of
all pages of a host, menus and articles alike, are laid end to end; a suffix array ordered through
``DEPTH`` tokens shows the substrings that come back, and those on at least ``PAGES`` pages of
different content are boilerplate. Blocks of which they cover ``COVER`` go. The markup is the exact
check that follows: what lies in the article comes back whole, or what lies in the main element
where that holds more text outside its articles than in them, and the rest goes; elements that
mark themselves as menus, headers, footers, sidebars, notices, adverts, forms or comments, by
their tag or by a whole class name of known boilerplate, go even where nothing repeats them. The
host's repetition decides where the markup is in doubt: on elements whose class may as well name a
part of the article (``DOUBTFUL``), and on all that is left of a page that marks neither. A
button within a sentence is a word of it; one that stands alone is a form's.

A host's pages are dealt into shards of about ``SHARD`` pages. Each shard's array is built in a
task and counts, for every group of suffixes equal through that depth, the pages it is on. Where a
host has several shards, each first sends the leading bits of its groups' keys, as gaps of some ten bits, dealt
into four buckets for each shard, and is told which of them another shard has too; only those groups
and the ones it repeats itself go out whole, with their counts, to be added up, and each shard gets back the
repeated groups that it holds, so no task gets a whole host. A page is shuffled once, its text compressed;
all these steps read that one shuffle.

Defined results: a null or empty page has the empty text; a page without a readable host shares
one nameless host; pages of equal content count once as evidence, and each repeated row gets
its own result. A link's null id or url is carried along; extra columns are ignored. Groups are
told apart by 64 bits.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import arrays
from pitchlake.llm.common import stored

DEPTH, PAGES, COVER, SHARD = 8, 3, 0.8, 2000
#: Leading bits of a key that are asked for, beside those of the number of shards; any number gives the same result.
BITS = 26
#: Added to the zone of a block in doubt.
UNSURE = 10

#: Elements by their part in a page.
RAW = set("script style noscript template textarea title iframe xmp noembed noframes plaintext".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    search section summary table tbody tfoot thead tr ul""".split())
CHROME = set("nav header footer aside form dialog menu search select svg object canvas audio video head".split())
#: Of these, those that lie within a line.
INLINE = set("select svg object canvas audio video".split())
#: Class names, ids and roles of what is no article.
NAMES = set("""ad ads advert adverts advertisement adsense sponsor sponsored promo promoted banner nav navbar navigation menu
    breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices popup modal overlay
    newsletter subscribe subscription signup login share sharing social comment comments disqus replies reply respond
    pagination pager complementary contentinfo dialog toolbar""".split())
#: Names that may be of either kind; the host's repetition decides.
DOUBTFUL = set("related recommended search widget widgets alert form".split())
#: What such a name may be joined with and still name boilerplate.
JOINED = set("""site page main top bottom left right header head foot list lists bar box block area section container wrapper
    wrap inner outer panel link links item items button buttons icon icons form unit slot zone module thread count toggle
    primary secondary global mobile desktop policy message text title""".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""(?i)(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[-_]+")


def _kind(name: str) -> int:
    """What a whole class name, id or role says: 0 nothing, 1 boilerplate, 2 in doubt."""
    if name in NAMES:
        return 1
    if name in DOUBTFUL:
        return 2
    parts = _PART.split(name)
    if len(parts) > 1 and all(p in NAMES or p in DOUBTFUL or p in JOINED or p.isdigit() for p in parts):
        return 1 if any(p in NAMES for p in parts) else 2 if any(p in DOUBTFUL for p in parts) else 0
    return 0


def _is_chrome(tag: str, attributes: str, inside: bool) -> int:
    """0 for an element of the page's text, 1 for boilerplate by its markup, 2 for one in doubt."""
    if tag in CHROME and not (inside and tag == "header"):
        return 1
    doubt = 0
    for name, value in _NAMED.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return 1
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return 1
        elif name == "aria-hidden":
            continue
        elif tag == "article":
            if name in ("class", "role") and {"comment", "comments"} & set(_PART.split(value.replace(" ", "-"))):
                return 1
        elif tag not in ("html", "body", "main"):
            kinds = {_kind(v) for v in value.split()}
            if 1 in kinds:
                return 1
            doubt = max(doubt, *kinds, 0) if kinds else doubt
    return doubt


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the blocks: -1 marked as chrome, 0 outside, 1 in a main element, 2 in an article;
    ``UNSURE`` more within an element in doubt."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    lone: list[str] = []  # what of the block lies in buttons
    stack: list[tuple[str, int, int]] = []  # open elements: tag, what it is by itself, zone
    chrome, zone, at, doubt, buttons = 0, 0, 0, 0, 0

    def close() -> None:
        whole = " ".join(html.unescape("".join(text)).split())
        form = " ".join(html.unescape("".join(lone)).split())
        text.clear()
        lone.clear()
        if whole and whole != form:
            out.append((-1 if chrome else zone + UNSURE * (doubt > 0), whole))

    n, inline, held = len(page), 0, 0  # where an element within the line began, and whether one is open
    while at < n:
        m = _TAG.search(page, at)
        piece = page[at:m.start() if m else n]
        text.append(piece)
        if buttons:
            lone.append(piece)
        if not m:
            break
        at = m.end()
        end, tag = m.group(1), m.group(2)
        if end:
            end = end.lower()
            if end in BLOCK and not held:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == end:
                    buttons -= sum(x[0] == "button" for x in stack[k:])
                    if held and any(x[1] and x[0] in INLINE for x in stack[k:]):
                        text[inline:] = [" "]  # what the element within the line held
                        chrome, held = chrome - 1, 0
                    if any(x[1] and x[0] not in INLINE for x in stack[k:]) or (end in BLOCK or zone != stack[k][2]) and not held:
                        close()
                    chrome -= sum(x[1] == 1 and x[0] not in INLINE for x in stack[k:])
                    doubt -= sum(x[1] == 2 for x in stack[k:])
                    zone = stack[k][2]
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main") and end not in ("body", "html", "article", "main"):
                    break  # a stray end tag closes nothing outside
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW:
            if tag == "plaintext":
                break
            stop = re.compile(rf"(?i)</{tag}(?=[\s/>])[^>]*>").search(page, at)
            at = stop.end() if stop else n
            text.append(" " if tag in ("textarea", "iframe") else "")
            continue
        if tag == "br" or tag in ("td", "th", "img"):
            text.append(" ")
        elif tag in BLOCK and not held:
            close()
        if tag in VOID or m.group(3).endswith("/") and tag in ("path", "use", "circle", "rect"):
            continue
        if tag in ("article", "main", "body") and chrome and all(
                not x[1] or x[0] in ("head", "nav", "header", "footer", "aside", "menu") for x in stack):
            if not any(x[0] == "article" for x in stack):  # the element before was never closed
                close()
                chrome, zone, doubt, buttons, held = 0, 0, 0, 0, 0
                stack.clear()
        mine = _is_chrome(tag, m.group(3), zone == 2)
        if mine and not chrome:
            if tag in INLINE:
                inline, held = len(text), 1
            else:
                close()
        elif mine and (held or tag in INLINE):
            mine = 0  # inside what goes anyway
        stack.append((tag, mine, zone))
        chrome += mine == 1
        doubt += mine == 2
        buttons += tag == "button"
        if not chrome and tag in ("article", "main"):
            close()
            zone = 2 if tag == "article" else max(zone, 1)
    if held:
        del text[inline:]
        chrome -= 1
    close()
    return out


def chosen(found: list[tuple[int, str]], covered: list[bool]) -> str:
    """Main text from a page's blocks and whether repeated substrings cover each."""
    size = [sum(len(t) for z, t in found if z == zone) for zone in (0, 1, 2)]
    least = 2 if size[2] and size[2] >= size[1] else 1 if size[1] or size[2] else 0
    own = [(z, t, c) for (z, t), c in zip(found, covered) if z >= 0 and z % UNSURE >= least]
    return "\n".join(t for z, t, c in own if not c or (least and z < UNSURE))


def decided(found: list[tuple[int, str]], covered: list[bool]) -> bool:
    """Whether the host's repetition changes the page's text."""
    return chosen(found, covered) != chosen(found, [False] * len(found))


def read(page: str | None) -> tuple[str | None, list[str]]:
    """Main text where the markup alone decides, else None and the open blocks."""
    found = blocks(page) if page else []
    if any(0 < z < UNSURE for z, _ in found) and all(z < UNSURE for z, _ in found):
        return chosen(found, [False] * len(found)), []
    rest = [t for z, t in found if z >= 0]
    return (None, rest) if rest else ("", [])


def suffix_groups(tokens: np.ndarray, ends: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each suffix its group of those equal through ``depth`` tokens; -1 where a page is shorter.

    The suffix array is ordered by prefix doubling, stopped at that depth; ``ends`` is where each
    token's page ends.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    got = 1
    while got < depth:
        step = min(got, depth - got)
        later = np.full(n, -1, np.int64)
        later[:n - step] = rank[step:]
        key = rank * (rank.max() + 2 if n else 1) + later + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        got += step
    rank[np.arange(n) + depth > ends] = -1
    return rank


class Shard:
    """The pages of one shard laid end to end; rows of equal content, which are neighbours, are one page."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        digest = np.array([r["digest"] for r in rows])
        new = np.diff(digest, prepend=digest[:1]) != 0
        new[:1] = True
        self.of = np.cumsum(new) - 1  # the page of each row
        pages = [rows[k] for k in np.flatnonzero(new).tolist()]
        parts = [p for r in pages for p in r["parts"]]
        words, of = arrays.word_hashes(*arrays.flat(pa.array(parts, pa.string())), lower=False)
        self.cuts = of  # where each block's words start
        self.first = np.concatenate([[0], np.cumsum([len(r["parts"]) for r in pages])]).astype(np.int64)
        ends = of[self.first]
        self.words, self.page = words, np.repeat(np.arange(len(pages)), np.diff(ends))
        self.keys, self.at = arrays.shingle_hashes(words, ends, DEPTH)
        self.end = ends[1:][self.page]

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Key of each group of suffixes and the number of pages it is on."""
        if not len(self.at):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        group = suffix_groups(self.words, self.end)[self.at]
        both = np.unique(group * (int(self.page.max()) + 1) + self.page[self.at]) // (int(self.page.max()) + 1)
        ids, count = np.unique(both, return_counts=True)
        key = np.zeros(int(ids.max()) + 1, np.uint64)
        key[group] = self.keys
        return key[ids], count

    def texts(self, common: np.ndarray) -> list[str]:
        """Each row's main text, with the keys of repeated groups."""
        steps = np.zeros(len(self.words) + 1, np.int64)
        hit = self.at[np.isin(self.keys, common)]
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + DEPTH, -1)
        total = np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)])[self.cuts]
        covered = (np.diff(total) >= COVER * np.diff(self.cuts)).tolist()
        return [chosen(list(zip(r["zones"], r["parts"])), covered[a:b])
                for r, a, b in zip(self.rows, self.first[:-1][self.of].tolist(), self.first[1:][self.of].tolist())]


def _closed(found: list[tuple[int, str]]) -> tuple[int, bytes, int, bytes]:
    """Digest of a page's blocks, their zones, and their compressed text with its size; no block holds a line feed."""
    body = "\n".join(t for _, t in found).encode()
    digest = int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)
    return digest, bytes(z + 1 for z, _ in found), len(body), pa.compress(body, "zstd", asbytes=True)


def _opened(rows: list[dict]) -> list[dict]:
    """The rows of a shard by digest, with zones and parts as lists; those of equal content share them."""
    last = None
    for r in rows:
        r["zones"] = [z - 1 for z in r["zones"]]
        if last is None or r["digest"] != last["digest"]:
            body = pa.decompress(r["body"], r["size"], "zstd", asbytes=True).decode()
            r["parts"] = body.split("\n") if body else []
            last = r
        r["parts"] = last["parts"]
        del r["body"]
    return rows


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each shard."""
    hold: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if hold and (r["host"], r["shard"]) != (hold[0]["host"], hold[0]["shard"]):
                yield _opened(hold)
                hold = []
            hold.append(r)
    if hold:
        yield _opened(hold)


def _told(rows: list[dict], texts: list[str], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r["page_id"] for r in rows], kind), pa.array([r["url"] for r in rows], pa.string()), pa.array(texts, pa.string())],
        ["page_id", "url", "text"])


def _leading(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each key by its leading bits, and the rest of these."""
    top = keys >> np.uint64(64 - BITS - shards.bit_length())
    return (top % np.uint64(4 * shards)).astype(np.int64), top // np.uint64(4 * shards)


def _gaps(values: np.ndarray) -> bytes:
    """Distinct values as the gaps between them, their bytes by place, compressed."""
    raw = np.diff(np.unique(values), prepend=np.uint64(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def _values(raw: bytes) -> np.ndarray:
    size = int.from_bytes(raw[:4], "little")
    gaps = np.frombuffer(pa.decompress(raw[4:], size, "zstd", asbytes=True), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view("<u4").ravel(), dtype=np.uint64)


ASKED = "host string, shard long, bucket long, bits binary"


def _bits(hosts: list[str], shards: list[int], buckets: list[int], bits: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array(shards, pa.int64()), pa.array(buckets, pa.int64()), pa.array(bits, pa.binary())],
        ["host", "shard", "bucket", "bits"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard and bucket, the leading bits of its keys."""
    for rows in _shards(batches):
        bucket, rest = _leading(Shard(rows).keys, rows[0]["shards"])
        order = np.argsort(bucket, kind="stable")
        each, at = np.unique(bucket[order], return_index=True)
        bits = [_gaps(x) for x in np.split(rest[order], at[1:])] if len(each) else []
        yield _bits([rows[0]["host"]] * len(each), [rows[0]["shard"]] * len(each), each.tolist(), bits)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each bucket of a host."""
    hold: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if hold and (r["host"], r["bucket"]) != (hold[0]["host"], hold[0]["bucket"]):
                yield hold
                hold = []
            hold.append(r)
    if hold:
        yield hold


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard and bucket, those of its leading bits that another shard has too."""
    for hold in _buckets(batches):
        own = [_values(r["bits"]) for r in hold]
        every, count = np.unique(np.concatenate(own), return_counts=True)
        both = every[count > 1]
        yield _bits(*([r[k] for r in hold] for k in ("host", "shard", "bucket")), [_gaps(x[np.isin(x, both)]) for x in own])


COUNTED = "host string, shard long, bucket long, keys binary, pages binary"


def _counted(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Per bucket, the keys of a shard's groups that others may have or that it repeats, and the pages each is on."""
    rows = _opened(rows.sort_by("digest").to_pylist())
    keys, pages = Shard(rows).groups()
    bucket, rest = _leading(keys, rows[0]["shards"])
    own = pages >= PAGES
    order = np.argsort(bucket, kind="stable")
    for r in answers.to_pylist():
        at = order[slice(*np.searchsorted(bucket[order], [r["bucket"], r["bucket"] + 1]))]
        own[at] |= np.isin(rest[at], _values(r["bits"]))
    each = [(b, np.flatnonzero(own & (bucket == b))) for b in np.unique(bucket[own]).tolist()]
    return pa.Table.from_arrays(
        [pa.array([rows[0]["host"]] * len(each), pa.string()), pa.array([rows[0]["shard"]] * len(each), pa.int64()),
         pa.array([b for b, _ in each], pa.int64()), arrays.dense([keys[at] for _, at in each], "<u8"),
         arrays.dense([np.minimum(pages[at], PAGES) for _, at in each], "u1")], ["host", "shard", "bucket", "keys", "pages"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket of a host, for each shard those of its groups that are on enough pages of the host."""

    def done(hold: list[dict]) -> pa.RecordBatch:
        keys = [np.frombuffer(r["keys"], "<u8") for r in hold]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([np.frombuffer(r["pages"], "u1") for r in hold]))
        common = every[total >= PAGES]
        return pa.RecordBatch.from_arrays(
            [pa.array([r["host"] for r in hold], pa.string()), pa.array([r["shard"] for r in hold], pa.int64()),
             arrays.dense([k[np.isin(k, common)] for k in keys], "<u8")], ["host", "shard", "keys"])

    yield from map(done, _buckets(batches))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^/?#]*//(?:[^@/?#]*@)?([^/?#:]*)", 1)), F.lit(""))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_closed(blocks(p) if p else []) for p in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *(pa.array([g[k] for g in got], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.binary())))],
                ["page_id", "url", "host", "shards", "digest", "zones", "size", "body"])

    kind = pages.schema["page_id"].dataType.simpleString()
    source = pages.select("page_id", "url", host.alias("host"), "html")
    # Shards are counted by the pages as they are, so a page is read only for the arrays of its host.
    hosts = stored(source.groupBy("host").agg(F.ceil(F.countDistinct(F.xxhash64("html")) / SHARD).alias("shards")), "hosts")

    def dealt(which: str) -> DataFrame:
        """Blocks of the pages of such hosts, at the shard that their content belongs to; never stored beside their shuffle."""
        placed = source.join(hosts.where(which), "host").select("page_id", "url", "host", "shards", "html")
        return placed.mapInArrow(
            cut, f"page_id {kind}, url string, host string, shards long, digest long, zones binary, size long, body binary").withColumn(
            "shard", F.pmod(F.xxhash64("digest"), F.col("shards"))).repartition("host", "shard")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(batches):
            shard = Shard(rows)
            keys, count = shard.groups()
            yield _told(rows, shard.texts(keys[count >= PAGES]), arrow)

    def parted(rows: pa.Table, sent: pa.Table) -> pa.Table:
        own = _opened(rows.sort_by("digest").to_pylist())
        keys = np.frombuffer(b"".join(sent.column("keys").to_pylist()), "<u8")
        return pa.Table.from_batches([_told(own, Shard(own).texts(keys), arrow)])

    arrow = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    result = f"page_id {kind}, url string, text string"
    out = dealt("shards = 1").sortWithinPartitions("host", "shard", "digest").mapInArrow(whole, result)
    if hosts.where("shards > 1").head(1):
        many = dealt("shards > 1")  # one shuffle, read by the three steps
        asked = many.sortWithinPartitions("host", "shard", "digest").mapInArrow(_asked, ASKED)
        answers = asked.repartition("host", "bucket").sortWithinPartitions("host", "bucket").mapInArrow(_answered, ASKED)
        shards = many.groupBy("host", "shard")
        groups = shards.cogroup(answers.groupBy("host", "shard")).applyInArrow(_counted, COUNTED)
        sent = groups.repartition("host", "bucket").sortWithinPartitions("host", "bucket").mapInArrow(
            _added, "host string, shard long, keys binary")
        out = out.union(shards.cogroup(sent.groupBy("host", "shard")).applyInArrow(parted, result))
    return out.withColumn("n_chars", F.length("text").cast("long"))
