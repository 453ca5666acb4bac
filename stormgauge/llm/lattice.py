"""Near-duplicate embeddings by E8 lattice hashing.

Unit vectors are projected at random to a few groups of eight dimensions, and each group is
decoded to its nearest E8 lattice point; the points of a table's groups make a cell.  Close
vectors share a cell in some table, or one lies in a neighbouring cell that the other
probes: each vector also enters the cell with the next lattice point in the group where the
decision was closest.  Vectors of one cell are compared by cosine in double precision.

Only vectors with the same, non-null label are compared.  Equal vectors are one node with a
weight.  Cells with one node are dropped before any vector moves; cells with very many are
cut into blocks that meet pairwise, so no task holds more than two blocks.  A linked pair
counts in the first cell that both share, so nothing is counted twice and pairs never leave
a task: what leaves are link counts and a spanning forest.

Vectors that are null, zero or hold null or non-finite components, and rows without label
or id link with nothing.  Vectors of different lengths are not compared.  Repeated rows are
vectors of their own that link with each other.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.common import components, staged
from stormgauge.llm.words import mix

COSINE = 0.98
TABLES = 12
GROUPS = 2
SCALE = 2.2
# nodes of a cell that are compared with each other in one go
BLOCK = 1024


def nearest_points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest and next E8 point (doubled, so integer) of each row of eight, and the margin.

    E8 is the union of D8 (integers with an even sum) and D8 shifted by one half.  In either
    one the nearest point is the rounded one or, if its sum is odd, the one with the worst
    coordinate rounded the other way; the next one changes one more such decision.
    """
    points, distances = [], []
    row = np.arange(len(x))
    for shift in (0.0, 0.5):
        z = x - shift
        near = np.round(z)
        off = z - near
        order = np.argsort(-np.abs(off), axis=1)
        worst, second = order[:, 0], order[:, 1]
        step = np.where(off >= 0, 1.0, -1.0)
        odd = near.sum(axis=1) % 2 != 0
        one, two = near.copy(), near.copy()
        one[row[odd], worst[odd]] += step[odd, worst[odd]]
        # odd: turn the second worst instead; even: turn both
        two[row, second] += step[row, second]
        two[row[~odd], worst[~odd]] += step[~odd, worst[~odd]]
        for p in (one, two):
            points.append(p + shift)
            distances.append(((x - p - shift) ** 2).sum(axis=1))
    distances = np.stack(distances, axis=1)
    order = np.argsort(distances, axis=1, kind="stable")
    points = np.stack(points, axis=1)
    first, second = order[:, 0], order[:, 1]
    margin = distances[row, second] - distances[row, first]
    double = np.rint(2 * points).astype(np.int64)
    return double[row, first], double[row, second], margin


def projections(dimensions: int, table: int) -> np.ndarray:
    """Random orthogonal directions of a table, the same in every task."""
    rng = np.random.default_rng((dimensions, table, 8))
    width = 8 * GROUPS
    gauss = rng.normal(size=(max(dimensions, 1), width))
    if dimensions >= width:
        return np.linalg.qr(gauss)[0]
    return gauss / np.sqrt(max(dimensions, 1))


def cells(unit: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Home cell and probed cell of each unit vector in each table, hashed: rows x tables x 2."""
    n, d = unit.shape
    out = np.zeros((n, TABLES, 2), np.uint64)
    odd = np.random.default_rng(88).integers(1, 2**63, 8 * GROUPS, dtype=np.uint64) | np.uint64(1)
    for table in range(TABLES):
        # a difference at the threshold has the same length in the projection for any d
        x = unit @ projections(d, table) * SCALE * np.sqrt(max(d, 1) / 8)
        parts = [nearest_points(x[:, 8 * g : 8 * g + 8]) for g in range(GROUPS)]
        home = np.concatenate([p[0] for p in parts], axis=1)
        other = home.copy()
        closest = np.stack([p[2] for p in parts], axis=1).argmin(axis=1)
        for g, part in enumerate(parts):
            at = np.flatnonzero(closest == g)
            other[at, 8 * g : 8 * g + 8] = part[1][at]
        for k, point in enumerate((home, other)):
            h = (point.astype(np.uint64) * odd).sum(axis=1, dtype=np.uint64)
            out[:, table, k] = mix(mix(h) ^ salt ^ np.uint64(table * 0x10001 + 1))
    return out


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors of a list column, all of one length, as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), dimensions)


def _unit(column: pa.Array, dimensions: int) -> np.ndarray:
    x = matrix(column, dimensions)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: str) -> F.Column:
    """Whether a list column is not null and holds finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _cells_of(nodes: DataFrame) -> DataFrame:
    schema = pa.schema([("node", pa.int64()), ("cells", pa.list_(pa.int64()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, label, vector = batch.columns
            size = vector.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(size).tolist():
                at = pa.array(np.flatnonzero(size == d))
                salt = mix(label.take(at).to_numpy(zero_copy_only=False).view(np.uint64) + np.uint64(d))
                found = cells(_unit(vector.take(at), d), salt)
                rows = found.reshape(len(at), -1).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [node.take(at), lists.cast(pa.list_(pa.int64()))], schema=schema
                )

    hashed = nodes.select("node", F.xxhash64("label").alias("label"), "vector")
    return staged(hashed.mapInArrow(place, "node long, cells array<long>"), "cells")


def compare(
    cell: int, node: np.ndarray, weight: np.ndarray, unit: np.ndarray, own: np.ndarray, side: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Weighted link counts of a block's nodes, counted in this cell, and a root for each.

    ``side`` is 0 and 1 for two blocks that meet, and 0 alone for a block with itself.
    """
    n = len(node)
    count, linked = np.zeros(n, np.int64), np.zeros((n, n), bool)
    target = np.uint64(cell % 2**64)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    for i in range(0, len(left), 128):
        rows = left[i : i + 128]
        near = unit[rows] @ unit[right].T >= COSINE
        a, b = np.nonzero(near)
        a, b = rows[a], right[b]
        kept = a != b if right is left else slice(None)
        a, b = a[kept], b[kept]
        linked[a, b] = linked[b, a] = True
        first = np.zeros(len(a), np.uint64)
        found = np.zeros(len(a), bool)
        for table in range(own.shape[1]):
            x, y = own[a, table], own[b, table]
            least = np.full(len(a), 2**64 - 1, np.uint64)
            shared = np.zeros(len(a), bool)
            for p in range(2):
                for q in range(2):
                    same = x[:, p] == y[:, q]
                    shared |= same
                    least = np.where(same, np.minimum(least, x[:, p]), least)
            fresh = shared & ~found
            first[fresh] = least[fresh]
            found |= shared
        counted = found & (first == target)
        np.add.at(count, a[counted], weight[b[counted]])
        if right is not left:
            np.add.at(count, b[counted], weight[a[counted]])
    root = node.copy()
    if linked.any():
        top = np.iinfo(np.int64).max
        while True:
            least = np.minimum(root, np.where(linked, root[None, :], top).min(axis=1))
            if (least == root).all():
                break
            root = least
    return count, root


def _compared(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """Partial link counts and roots ``(node, n, root)`` of all blocks."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])
    entries = placed.select("node", F.explode(F.array_distinct("cells")).alias("cell"))
    counts = entries.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    entries = staged(
        entries.join(counts, "cell").select("node", "cell", blocks.alias("blocks")), "entries"
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    met = entries.withColumn("own", own).select(
        "node", "cell", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("met")
    )
    met = met.select(
        "node",
        "cell",
        F.least("own", "met").alias("low"),
        F.greatest("own", "met").alias("high"),
        (F.col("own") > F.col("met")).cast("int").alias("side"),
    )
    full = met.join(nodes.select("node", "weight", "vector").join(placed, "node"), "node")
    full = full.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]
            cuts.append(batch.num_rows)
            for begin, end in zip(cuts, cuts[1:]):
                part = batch.slice(begin, end - begin)
                if held and any(held[-1].column(k)[-1] != part.column(k)[0] for k in range(3)):
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(part)
        if held:
            yield pa.Table.from_batches(held)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], []]
        size = 0
        for group in groups(batches):
            if group.num_rows < 2:
                continue
            cell, _, _, side, node, weight, own, vector = (
                c.combine_chunks() for c in group.itercolumns()
            )
            node = node.to_numpy(zero_copy_only=False)
            d = len(vector[0])
            count, root = compare(
                cell[0].as_py(),
                node,
                weight.to_numpy(zero_copy_only=False),
                _unit(vector, d),
                own.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(node), -1, 2),
                side.to_numpy(zero_copy_only=False),
            )
            some = np.flatnonzero((count > 0) | (root != node))
            for column, value in zip(out, (node, count, root)):
                column.append(value[some])
            size += len(some)
            if size > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)
                out, size = [[], [], []], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)

    columns = ("cell", "low", "high", "side", "node", "weight", "cells", "vector")
    return staged(full.select(*columns).mapInArrow(work, "node long, n long, root long"), "counts")


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row ``(vec_id, n_links, component_id, kept)`` per vector.

    Links are the pairs found with a cosine of ``COSINE`` or more.  ``component_id`` is the
    smallest id reachable by links; ``kept`` marks the vector with that id.  A row without
    id has neither links nor a component and is not kept.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.col(vector).alias("vector"),
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector") & nonzero
    # two hashes with different seeds stand for label and vector
    marked = rows.select(
        "vec_id",
        "label",
        "vector",
        F.when(whole, F.xxhash64("label", "vector")).alias("node"),
        F.xxhash64(F.lit(1), "vector", "label").alias("check"),
    )
    nodes = marked.where("node is not null").groupBy("node", "check").agg(
        F.min("vec_id").alias("rep"),
        F.count("*").alias("weight"),
        F.first("label").alias("label"),
        F.first("vector").alias("vector"),
    )
    nodes = staged(nodes, "nodes")
    counts = _compared(nodes, _cells_of(nodes))
    links = counts.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(
        counts.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    )
    named = nodes.select("node", "rep", "weight").join(roots, "node", "left").join(links, "node", "left")
    named = staged(
        named.select(
            "node",
            "rep",
            F.coalesce("root", "node").alias("root"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ),
        "named",
    )
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("node", "n_links", "component_id")
    linked = marked.where("node is not null").select("vec_id", "node").join(named, "node")
    alone = marked.where("node is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
