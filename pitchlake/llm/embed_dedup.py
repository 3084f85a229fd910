"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells.

Equal vectors of a label are one node with a count. Unit centroids are fitted by spherical
k-means in numpy on at most about ``SAMPLE`` vectors; every vector is assigned to the cell of
its closest centroid. A vector within the angle of the threshold can only lie in another cell
if the plane between both centroids is within that angle too, so a node also visits each cell
of which that holds: links over the edge of a cell are found as well, and no pair is lost.

A label's cell is dealt into blocks of about ``BLOCK`` nodes and its visitors into blocks as
well; a task multiplies one with the other in double precision, counts each visitor's links and
returns one link for each node to the smallest of its component there. components.stars joins
these, and the vector with the smallest id stands for its group.

Defined results: vectors that are null, zero or hold null or non-finite components, and those
with a null label or id, link with nothing and are kept (a null id has a null component);
vectors of different lengths never link; equal vectors link, repeated rows too. Different vectors
of one vec_id are apart, and link like any others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import stored
from pitchlake.llm.components import stars
from pitchlake.llm.simhash import joined

LEAST = 0.93
SAMPLE, ROUNDS = 20_000, 10
#: Nodes of one label that a cell is made for, most cells, and nodes of a block.
CELL, CELLS, BLOCK = 4096, 512, 1024


def _vectors(column: pa.Array) -> list[bytes | None]:
    """Each usable vector as the bytes of its doubles."""
    out = []
    for x in column:
        v = x.values if x.is_valid else None
        if v is None or not len(v) or v.null_count:
            out.append(None)
            continue
        a = v.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no negative zero
        out.append(a.tobytes() if np.isfinite(a).all() and a.any() else None)
    return out


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, seed: int = 3) -> np.ndarray:
    """Unit centroids of unit vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        home = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norm = np.sqrt((sums * sums).sum(axis=1))
        c[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return c


def cells(x: np.ndarray, c: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and which cells may hold a vector within the threshold."""
    near = x @ c.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * c @ c.T))
    reach = np.sqrt(1 - least * least) if least > 0 else np.inf
    visits = near[np.arange(len(x)), home][:, None] - near <= reach * apart[home] + 1e-9
    visits[np.arange(len(x)), home] = True
    return home, visits


def rows(table: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of every row; vec is null where the vector can't be used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = pa.array(_vectors(batch.column(2)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), vec], ["vec_id", "label", "vec"])

    kinds = [table.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return table.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {kinds[0]}, label {kinds[1]}, vec binary")


def centroids(nodes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Centroids by length of vector, fitted on a sample picked by hash."""
    total, most = nodes.groupBy("label").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    if not total:
        return {}
    k = int(min(CELLS, -(-most // CELL)))
    span = 1 << 24
    picked = nodes.where(F.pmod(F.xxhash64("vec"), F.lit(span)) < int(span * min(1.0, sample / total)))
    by_dim: dict[int, list[bytes]] = {}
    for r in sorted(bytes(r["vec"]) for r in picked.select("vec").limit(2 * sample).collect()):
        by_dim.setdefault(len(r) // 8, []).append(r)
    return {dim: kmeans(unit(raw, dim), k) for dim, raw in by_dim.items()}


def assigned(nodes: DataFrame, found: dict[int, np.ndarray], least: float) -> DataFrame:
    """The nodes with their home cell and the cells they visit."""
    shared = nodes.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index("vec")).to_pylist()
            home, visits = [0] * len(raw), [[0]] * len(raw)
            for dim in {len(r) // 8 for r in raw} & set(own):
                at = [i for i, r in enumerate(raw) if len(r) == 8 * dim]
                h, v = cells(unit([raw[i] for i in at], dim), own[dim], least)
                for i, a, b in zip(at, h, v):
                    home[i], visits[i] = int(a), np.flatnonzero(b).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home, pa.int32()), pa.array(visits, pa.list_(pa.int32()))],
                [*batch.schema.names, "home", "visits"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{kinds}, home int, visits array<int>")


def compare(homes: tuple, visitors: tuple, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Visitors, their number of links here, and (node, smallest linked node) of all linked nodes.

    Both sides are (ids, copies, unit vectors).
    """
    ids, at = np.unique(np.concatenate([homes[0], visitors[0]]), return_inverse=True)
    h, v = at[:len(homes[0])], at[len(homes[0]):]
    labels = np.arange(len(ids))
    count = np.zeros(len(v), np.int64)
    for lo in range(0, len(v), 256):
        hit = (visitors[2][lo:lo + 256] @ homes[2].T >= least) & (v[lo:lo + 256, None] != h[None, :])
        count[lo:lo + 256] = hit @ homes[1]
        x, y = np.nonzero(hit)
        labels = joined(len(ids), v[lo + x], h[y], labels)
    moved = np.flatnonzero(labels != np.arange(len(ids)))
    return visitors[0], count, ids[moved], ids[labels[moved]]


def links(nodes: DataFrame, least: float = LEAST) -> DataFrame:
    """(node, n, root): counts of links (root null) and links (n null) from all tasks."""
    placed = stored(assigned(nodes, centroids(nodes), least).withColumn("dim", F.length("vec")), "cells")
    place = ["label", "dim", "cell"]
    visits = placed.select("node", "copies", "label", "dim", "vec", "home", F.explode("visits").alias("cell"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    sizes = stored(visits.groupBy(place).agg(
        blocks(F.count("*")).alias("vs"), blocks(F.sum((F.col("home") == F.col("cell")).cast("int"))).alias("hs")), "sizes")
    each = visits.join(sizes, place)
    mine = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    all_ = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sent = each.select(*place, mine("vs", 1).alias("v"), all_("hs").alias("h"), F.lit(1).alias("role"), "node", "copies", "vec").union(
        each.where("home = cell").select(*place, all_("vs").alias("v"), mine("hs", 2).alias("h"), F.lit(0).alias("role"),
                                         "node", "copies", "vec"))
    key = [*place, "h", "v"]
    sent = sent.withColumn("task", F.xxhash64(*key)).repartition(*key).sortWithinPartitions("task", *key, "role", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold: list[tuple] = []
        now = None

        def done() -> pa.RecordBatch:
            sides = []
            for role in (0, 1):
                own = [r for r in hold if r[0] == role]
                dim = len(hold[0][3]) // 8
                sides.append((np.array([r[1] for r in own], np.int64), np.array([r[2] for r in own], np.int64),
                              unit([r[3] for r in own], dim) if own else np.zeros((0, dim))))
            who, n, a, b = compare(*sides, least)
            who, n = who[n > 0], n[n > 0]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([who, a])),
                 pa.array([*n.tolist(), *[None] * len(a)], pa.int64()), pa.array([*[None] * len(n), *b.tolist()], pa.int64())],
                ["node", "n", "root"])

        for batch in batches:
            cols = {c: batch.column(batch.schema.get_field_index(c)).to_pylist()
                    for c in (*key, "role", "node", "copies", "vec")}
            for i in range(batch.num_rows):
                this = tuple(cols[c][i] for c in key)
                if hold and this != now:
                    yield done()
                    hold = []
                now = this
                hold.append(tuple(cols[c][i] for c in ("role", "node", "copies", "vec")))
        if hold:
            yield done()

    return sent.mapInArrow(run, "node long, n long, root long")


def near_duplicates(table: DataFrame, least: float = LEAST) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    every = rows(table)
    usable = F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # Nodes are numbered on their stored rows: vectors that share a vec_id stay apart.
    nodes = stored(every.where(usable).groupBy("label", "vec").agg(
        F.min("vec_id").cast("long").alias("least"), F.count("*").alias("copies")).withColumn(
        "node", F.monotonically_increasing_id()), "vectors")
    found = stored(links(nodes.drop("least"), least), "links")
    counts = found.where("n is not null").groupBy("node").agg(F.sum("n").alias("n"))
    groups = stars(found.where("root is not null").select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = stored(
        nodes.join(counts, "node", "left").join(groups, nodes.node == groups.u, "left").select(
            "label", "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "least", F.coalesce("v", "node").alias("root")), "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    result = stored(rooted.join(named, "root").select("label", "vec", "n_links", "component_id"), "result")
    own = every.where(usable).join(result, ["label", "vec"])
    alone = every.where(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    out = own.select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
