"""SimHash near-duplicates, searched with BK-trees.

A text's fingerprint takes bit i if more than half of its shingles' XXH64 hashes have it. Equal
fingerprints are one node. The 64 bits fall into six blocks; of six blocks at most four can
hold a differing bit, so two fingerprints within four bits agree on two whole blocks: each node
goes to the fifteen shards named by a pair of blocks and their bits, and no link is lost. A
shard's nodes form a BK-tree whose children are keyed by their Hamming distance to the parent,
and a node searches the trees of its shards along edges within the radius of its own distance.
Trees are sent to tasks by shard, not to every task, since all of them grow with the corpus.

A shard of more than ``SHARD`` nodes is dealt into chunks by hash and every two chunks meet in
a task of their own, so a task never gets more than two chunks. Tasks return at most one link
for each node, to the smallest of its component there; components.stars joins these.

Defined results: a null or empty text has fingerprint zero and is linked like any other; a null
id is linked with nothing and has a null component; rows that repeat an id are in one group only
if their fingerprints are linked, though groups may then be called by the same id. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm import arrays
from pitchlake.llm.common import stored
from pitchlake.llm.components import stars

WORDS, RADIUS, SEED = 4, 4, 42
#: Nodes of one chunk of a shard.
SHARD = 4096
#: (first bit, bits) of the six blocks.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
PAIRS = list(combinations(range(6), 2))
#: Pairs of a node and a tree's node that are looked at together.
FRONT = 1 << 20


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Fingerprint of a whole text; only A-Z are lower-cased."""
    ones, n, carry = np.zeros(64, np.int64), 0, []
    data = np.frombuffer(text, np.uint8)
    digest = xxhash.xxh64_digest
    for lo, hi in arrays.slices(data, np.array([0, len(data)])):
        found = carry + text[lo:hi].lower().split()
        carry = found[-(words - 1):] if words > 1 else []
        if len(found) < words:
            carry = found
            continue
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in
                           zip(starts[:len(found) - words + 1].tolist(), ends[words - 1:].tolist())])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(bits)
    if not n and carry:
        ones += np.unpackbits(np.frombuffer(digest(b" ".join(carry), SEED), np.uint8))
        n = 1
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.flat(batch.column(1))
            raw = [fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(raw, np.uint64).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def joined(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest node of each node's component."""
    labels = np.arange(n) if labels is None else labels.copy()
    while len(a):
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
    return labels


def grow(fp: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """BK-trees over many shards at once: parent, edge, and the nodes of each level.

    ``root`` is each node's first node in its shard. All nodes that reach the same edge of a
    parent go on from the first of them, which becomes the child.
    """
    n = len(fp)
    parent, edge = np.full(n, -1), np.zeros(n, np.int64)
    left = np.flatnonzero(root != np.arange(n))
    at = root[left]
    levels = [np.flatnonzero(root == np.arange(n))]
    while len(left):
        d = np.bitwise_count(fp[left] ^ fp[at]).astype(np.int64)
        _, first, group = np.unique(at * 65 + d, return_index=True, return_inverse=True)
        child = left[first]
        parent[child], edge[child] = at[first], d[first]
        levels.append(child)
        rest = np.ones(len(left), bool)
        rest[first] = False
        left, at = left[rest], child[group[rest]]
    return parent, edge, levels


def local_links(shard: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Smallest node linked to each node within its shard; shards lie together."""
    n = len(fp)
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    size = np.diff(np.concatenate([first, [n]]))
    root = np.repeat(first, size)
    parent, edge, levels = grow(fp, root)
    near = np.flatnonzero((parent >= 0) & (edge <= radius))
    labels = joined(n, near, parent[near])
    # Label of a whole subtree where it has but one: a node with that label has nothing to find there.
    whole = labels.copy()
    for nodes in reversed(levels[1:]):
        np.maximum.at(whole, parent[nodes], np.where(whole[nodes] == labels[parent[nodes]], -1, n))
    whole[whole >= n] = n
    child_at = np.argsort(np.where(parent >= 0, parent * 65 + edge, np.int64(1) << 62), kind="stable")[:n - len(first)]
    child_key = parent[child_at] * 65 + edge[child_at]
    seek = np.flatnonzero(whole[root] != labels)
    cost = np.cumsum(np.repeat(size, size)[seek])
    found = []
    at = 0
    while at < len(seek):
        to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + FRONT)))
        q = seek[at:to]
        node = root[q]
        at = to
        while len(q):
            d = np.bitwise_count(fp[q] ^ fp[node]).astype(np.int64)
            hit = (d <= radius) & (labels[q] != labels[node])
            if hit.any():
                found.append(np.stack([q[hit], node[hit]]))
            lo = np.searchsorted(child_key, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(child_key, node * 65 + np.minimum(d + radius, 64), "right")
            many = hi - lo
            q = np.repeat(q, many)
            node = child_at[np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(len(q))]
            open_ = whole[node] != labels[q]
            q, node = q[open_], node[open_]
        if sum(x.shape[1] for x in found) > FRONT:
            both = np.concatenate(found, axis=1)
            labels_now = joined(n, both[0], both[1], labels)
            keep = np.flatnonzero(labels_now != np.arange(n))
            found = [np.stack([keep, labels_now[keep]])]
    if found:
        both = np.concatenate(found, axis=1)
        labels = joined(n, both[0], both[1], labels)
    return labels


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): for ``nodes`` (node, fp), links that join all nodes within ``radius`` bits."""
    keys = F.array(*[
        F.shiftleft(F.lit(i).cast("long"), 22).bitwiseOR(_bits(a)).bitwiseOR(F.shiftleft(_bits(b), BLOCKS[a][1]))
        for i, (a, b) in enumerate(PAIRS)])
    dealt = nodes.select("node", "fp", F.explode(keys).alias("shard"))
    sizes = dealt.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    shared = dealt.join(stored(sizes, "shards"), "shard")
    chunks = F.ceil(F.col("n") / SHARD).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), chunks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), chunks - 1), lambda j: F.struct(
        F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    met = shared.select("shard", "node", "fp", F.explode(meets).alias("m")).select(
        "shard", F.col("m.i").alias("i"), F.col("m.j").alias("j"), "node", "fp")
    met = met.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold: list[list[np.ndarray]] = []

        def done(columns: list[np.ndarray]) -> pa.RecordBatch:
            shard, i, j, node, fp = columns
            new = np.concatenate([[True], (shard[1:] != shard[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            least = local_links(np.cumsum(new), fp.view(np.uint64), radius)
            at = np.flatnonzero(least != np.arange(len(least)))
            return pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[least[at]])], ["a", "b"])

        def columns() -> list[np.ndarray]:
            return [np.concatenate(c) for c in zip(*hold)]

        for batch in batches:
            if batch.num_rows:
                hold.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if sum(len(h[0]) for h in hold) < 16 * SHARD:
                continue
            all_ = columns()
            last = (all_[0] == all_[0][-1]) & (all_[1] == all_[1][-1]) & (all_[2] == all_[2][-1])
            cut = int(np.flatnonzero(last)[0])  # the last shard may go on in the next batch
            if cut:
                yield done([c[:cut] for c in all_])
            hold = [[c[cut:] for c in all_]]
        if hold:
            yield done(columns())

    return met.mapInArrow(run, "a long, b long")


def _bits(block: int):
    at, bits = BLOCKS[block]
    return F.shiftrightunsigned(F.col("fp"), at).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _groups(docs: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (fp, first): for each fingerprint the first row of its group.

    Nodes are fingerprints, so rows that repeat an id share a group only if their texts do. A
    row is named by its id and the hash of its text.
    """
    named = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    prints = stored(fingerprints(named).select("doc_id.doc_id", "doc_id.h", "fp"), "fingerprints")
    nodes = stored(prints.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(
        F.min(F.struct("doc_id", "fp", "h")).alias("own")), "nodes")
    found = stars(links(nodes.select(F.col("fp").alias("node"), "fp"), radius))
    rooted = stored(nodes.join(found, nodes.fp == found.u, "left").select("fp", "own", F.coalesce("v", "fp").alias("root")), "rooted")
    first = rooted.groupBy("root").agg(F.min("own").alias("first"))
    return prints, stored(rooted.join(first, "root").select("fp", "first"), "groups")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    prints, groups = _groups(docs, radius)
    return prints.join(groups, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("first.doc_id").cast("long")).alias("component_id"))


def hexadecimal(fp: str):
    """16 lower-case digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def representatives(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group: that with the smallest id; rows with a null id all stay.

    Of rows that repeat this id within the group one stays: by fingerprint, hash of the text, and then the
    content of its other columns, so the same row under any partitioning.
    """
    _, groups = _groups(docs, radius)
    keep = groups.select("first.doc_id", F.col("first.h").alias(_HASH)).distinct()
    plain = [f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    place = Window.partitionBy("doc_id", _HASH).orderBy(F.xxhash64(*plain), *plain)
    chosen = docs.withColumn(_HASH, F.xxhash64("text")).join(keep, ["doc_id", _HASH], "left_semi")
    first = chosen.withColumn(_PLACE, F.row_number().over(place)).where(F.col(_PLACE) == 1)
    return first.select(docs.columns).union(docs.where(F.col("doc_id").isNull()))


#: Names of columns that documents will not have.
_HASH, _PLACE = "__text_hash", "__place"
