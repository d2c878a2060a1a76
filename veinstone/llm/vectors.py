"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine >= 0.95 lie within squared distance 2(1 - 0.95). After a fixed random
rotation, which spreads the difference evenly, the dimensions are split into blocks; if a pair
is within the budget, it is within the block's share of it (in proportion to the block's
dimensions) in at least one block. So each block is range-joined by itself under its share:
vectors are dealt to grid cells on the block's first coordinates, with cells as wide as the
block's radius, and go also to those neighbouring cells "ahead" that the radius reaches. Within
a cell, lots of at most LOT rows are compared in the block by matrix products, STEP rows at a time;
what is within the share is verified by the cosine of the vectors as they came, in double
precision, and counted in the first block that qualifies, so that no pair counts twice. Pairs are
never emitted: tasks return counts and, per linked vector, one link to its lot's component.

Up to LOT vectors of a length make one cell a block. More have a grid of two coordinates, and one
more for each further factor of GROWTH in their number, as far as the grid has at most GRID_CELLS
cells in all blocks. Cells that hold more than a lot are split into lots by a hash, with every pair
of lots a task of its own, so a dense cell of n different vectors sends each to n / LOT tasks. Lots
carry the vectors as they came and rotate them again, by the same sums in the same order.

Equal vectors (by 128 bits) are one representative with a weight before all this, so groups of exact
copies cost one row. The cells' counts are bounded by the grid, not by the data, and broadcast.

Defined results: keys may be of any type that can be ordered; vectors that are null, empty, zero or
hold null or non-finite components link with nothing, as do vectors of different lengths; ties
cannot arise; repeated rows (equal key and vector) are one vector each; a component's id is the
least key of its vectors, nulls last; an empty table gives an empty result; key and vector are
read, no other column.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import discard, mix64, written
from veinstone.llm.graph import components

COSINE = 0.95
BLOCK_DIMENSIONS = 16
#: Rows of a cell that one task compares with as many others; rows whose products are held at a time.
LOT, STEP = 8192, 2048
GROWTH, GRID_CELLS = 8, 1 << 21
SEED = 11


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64([SEED, d])).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def blocks_of(d: int) -> list[tuple[int, int]]:
    return [(a, min(d, a + BLOCK_DIMENSIONS)) for a in range(0, d, BLOCK_DIMENSIONS)]


def share(a: int, b: int, d: int, cosine: float) -> float:
    """The squared-distance budget of dimensions a to b, with slack for rounding."""
    return 2 * (1 - cosine) * (b - a) / d + 1e-9


def grid_for(n: int, d: int, cosine: float) -> int:
    """Coordinates of the grid in each block, for n vectors of d dimensions."""
    if n <= LOT:
        return 0
    blocks = blocks_of(d)
    wanted = 2 + int(np.log(n / LOT) / np.log(GROWTH))
    across = 2 / min(np.sqrt(share(a, b, d, cosine)) for a, b in blocks) + 1
    affordable = int(np.log(GRID_CELLS / len(blocks)) / np.log(across))
    return max(1, min(wanted, affordable, 4))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows over the power of two of their largest component, which rounds nothing."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def turned(x: np.ndarray) -> np.ndarray:
    """Rotated rows of unit length. Sums go dimension by dimension, so that a row's are the same in every task."""
    unit, r = x / lengths(x)[:, None], rotation(x.shape[1])
    out = np.zeros_like(unit)
    for k in range(len(r)):
        out += unit[:, k : k + 1] * r[k]
    return out


def cells_of(at: np.ndarray, a: int, b: int, radius: float, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates on the block's grid, and the cell of each row."""
    at = at[:, a : min(b, a + grid)]
    return at, np.floor(at / radius).astype(np.int64)


def cell_key(cell: np.ndarray) -> np.ndarray:
    key = np.zeros(len(cell), np.int64)
    for k in range(cell.shape[1]):
        key = key * 32768 + cell[:, k] + 16384
    return key


def ahead(n: int) -> list[tuple[int, ...]]:
    """The half of the steps to neighbouring cells along which vectors visit; along the other half they are visited."""
    return [step for step in itertools.product((-1, 0, 1), repeat=n) if step > (0,) * n]


def key_step(step: tuple[int, ...]) -> int:
    """What a step adds to a cell's key."""
    return sum(x * 32768**k for k, x in enumerate(reversed(step)))


class Counts:
    """How many vectors live in each cell, by length and block."""

    def __init__(self, table: pa.Table):
        self.of: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        dim, block, cell, n = (table.column(c).to_numpy() for c in ("dim", "block", "cell", "n"))
        order = np.lexsort((cell, block, dim))
        dim, block, cell, n = dim[order], block[order], cell[order], n[order]
        ends = np.flatnonzero(np.concatenate([(dim[1:] != dim[:-1]) | (block[1:] != block[:-1]), [True]])) + 1 if len(dim) else []
        for a, b in zip([0, *ends], ends):
            self.of[int(dim[a]), int(block[a])] = cell[a:b], n[a:b]

    def at(self, dim: int, block: int, cells: np.ndarray) -> np.ndarray:
        own, n = self.of[dim, block]
        i = np.searchsorted(own, cells).clip(max=len(own) - 1)
        return np.where(own[i] == cells, n[i], 0)


def _vectors(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Vectors of one length, from bytes of floats or doubles."""
    dim, values = rows.column("dim")[0].as_py(), rows.column("vector").to_pylist()
    return np.frombuffer(b"".join(values), np.float32 if len(values[0]) == 4 * dim else np.float64).reshape(len(values), dim).astype(np.float64)


def _place(cosine: float, grids: dict[int, int], counts: Counts | None):
    """counts None: each row's own cells, for counting; else rows for the lots' tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                rows = batch.slice(start, 2048)
                dims = rows.column("dim").to_numpy()
                for d in np.unique(dims).tolist():
                    own = rows.filter(pa.array(dims == d))
                    ids, weights = own.column("id").to_numpy(), own.column("weight").to_numpy()
                    at = turned(scaled(_vectors(own)))
                    for k, (a, b) in enumerate(blocks_of(d)):
                        radius = float(np.sqrt(share(a, b, d, cosine)))
                        spot, cell = cells_of(at, a, b, radius, grids[d])
                        key = cell_key(cell)
                        if counts is None:
                            cells, n = np.unique(key, return_counts=True)
                            yield pa.record_batch({"dim": pa.array(np.full(len(cells), d), pa.int32()), "block": pa.array(np.full(len(cells), k), pa.int32()), "cell": pa.array(cells), "n": pa.array(n)})
                            continue
                        parts = [(key, np.zeros(len(key), np.int8), np.arange(len(key)))]
                        for step in ahead(cell.shape[1]):
                            there = cell + np.array(step)
                            gap = np.maximum(0, np.maximum(there * radius - spot, spot - (there + 1) * radius))
                            some = np.flatnonzero((gap * gap).sum(1) <= radius * radius)
                            parts.append((cell_key(there[some]), np.ones(len(some), np.int8), some))
                        key, visits, row = (np.concatenate(x) for x in zip(*parts))
                        lots = -(-counts.at(d, k, key) // LOT)
                        full = lots > 0  # nobody lives in other cells
                        key, visits, row, lots = key[full], visits[full], row[full], lots[full]
                        # guests come from the cells behind; where these are full, in as many groups as they fill
                        groups = sum((counts.at(d, k, key - key_step(step)) for step in ahead(cell.shape[1])), np.zeros(len(key), np.int64))
                        groups = np.maximum(1, -(-groups // (2 * LOT)))
                        luck = mix64(ids[row].astype(np.uint64)) >> np.uint64(1)
                        mine, group = (luck % lots.astype(np.uint64)).astype(np.int64), (luck // np.uint64(1 << 20) % groups.astype(np.uint64)).astype(np.int64)
                        # residents meet each other lot of their cell, and all groups of guests; guests meet every lot
                        guests = visits == 1
                        times = np.where(guests, lots, lots - 1 + groups)
                        which = np.repeat(np.arange(len(key)), times)
                        turn = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                        guest, own_lot, n_lots = guests[which], mine[which], lots[which]
                        other = np.where(turn < n_lots - 1, turn + (turn >= own_lot), own_lot)
                        i = np.where(guest, turn, np.minimum(own_lot, other))
                        j = np.where(guest, turn, np.maximum(own_lot, other))
                        visitors = np.where(guest, group[which], np.maximum(0, turn - (n_lots - 1)))
                        role = np.where(guest, -1, own_lot)
                        yield pa.record_batch({
                            "dim": pa.array(np.full(len(which), d), pa.int32()), "block": pa.array(np.full(len(which), k), pa.int32()), "cell": pa.array(key[which]), "i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)),
                            "visitors": pa.array(visitors.astype(np.int32)), "role": pa.array(role.astype(np.int32)), "id": pa.array(ids[row][which]), "weight": pa.array(weights[row][which]), "vector": own.column("vector").take(pa.array(row[which])),
                        })

    return run


class Lots:
    """The rows of one task: as they came (scaled), their lengths, and rotated."""

    def __init__(self, x: np.ndarray):
        self.x = scaled(x)
        self.length, self.at = lengths(self.x), turned(self.x)

    def links(self, p: np.ndarray, q: np.ndarray | None, block: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """The linked pairs of rows p and q (of p with each other without q) that count in this block."""
        d = self.x.shape[1]
        spans = blocks_of(d)
        a, b = spans[block]
        budget = share(a, b, d, cosine)
        u = self.at[p, a:b]
        v = u if q is None else self.at[q, a:b]
        near = (u * u).sum(1)[:, None] + (v * v).sum(1)[None] - 2 * u @ v.T <= budget + 1e-9
        i, j = np.nonzero(np.triu(near, 1) if q is None else near)
        i, j = p[i], (p if q is None else q)[j]
        keep = []
        for s in range(0, len(i), 1 << 16):
            e, f = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
            ok = (self.x[e] * self.x[f]).sum(1) / (self.length[e] * self.length[f]) >= cosine
            gaps = (self.at[e] - self.at[f]) ** 2
            ok &= gaps[:, a:b].sum(1) <= budget
            for c, g in spans[:block]:
                ok &= gaps[:, c:g].sum(1) > share(c, g, d, cosine)
            keep.append(np.flatnonzero(ok) + s)
        keep = np.concatenate(keep) if keep else np.zeros(0, np.int64)
        return i[keep], j[keep]


def _join(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        role, ids, weights = (table.column(c).to_numpy() for c in ("role", "id", "weight"))
        block, i, j, visitors = (table.column(c)[0].as_py() for c in ("block", "i", "j", "visitors"))
        own = Lots(_vectors(table))
        left, right = np.flatnonzero(role == i), np.flatnonzero(role == (j if i != j else -1))
        n, root = np.zeros(len(ids)), np.arange(len(ids))

        def add(a: np.ndarray, b: np.ndarray) -> None:
            if len(a):
                n[:] += np.bincount(a, weights[b], len(ids)) + np.bincount(b, weights[a], len(ids))
                lowered(root, a, b)

        for s in range(0, len(left), STEP):
            for t in range(0, len(right), STEP):
                add(*own.links(left[s : s + STEP], right[t : t + STEP], block, cosine))
        if i == j and visitors == 0:
            for s in range(0, len(left), STEP):
                add(*own.links(left[s : s + STEP], None, block, cosine))
                for t in range(s + STEP, len(left), STEP):
                    add(*own.links(left[s : s + STEP], left[t : t + STEP], block, cosine))
        some = np.flatnonzero(n > 0)
        return pa.table({"id": pa.array(ids[some]), "n": pa.array(n[some].astype(np.int64)), "root": pa.array(ids[root[some]])})

    return run


def lowered(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a and b pair by pair, in place; root names each row's group by a row of it, the group's own by itself."""
    while True:
        p, q = root[a], root[b]
        open_ = p != q
        if not open_.any():
            return
        low, high = np.minimum(p[open_], q[open_]), np.maximum(p[open_], q[open_])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root[:] = root[root]


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """key, n_links (other vectors at this cosine or above), component_id (least key reachable by links) and kept."""
    v = F.col("vector")
    narrow = vectors.schema[vector].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.coalesce((F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0.0), F.lit(False))
    keyed = rows.select("key", F.when(fine, F.transform(v, lambda x: x + 0.0)).alias("vector")).select("key", "vector", F.xxhash64("vector").alias("s1"), F.xxhash64(F.lit(1), "vector").alias("s2"))
    valid = keyed.where("vector is not null")
    place = F.struct(F.col("key").isNull().alias("none"), "key")
    equal = valid.groupBy("s1", "s2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector"))
    reps = written(equal.withColumns({"dim": F.size("vector"), "id": F.monotonically_increasing_id()}), "vectors")
    grids = {r["dim"]: grid_for(r["n"], r["dim"], cosine) for r in reps.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}  # a row a length
    packed = reps.select("id", "weight", "dim", "vector").mapInArrow(_pack(np.float32 if narrow else np.float64), "id long, weight long, dim int, vector binary")
    counted = packed.mapInArrow(_place(cosine, grids, None), "dim int, block int, cell long, n long").groupBy("dim", "block", "cell").agg(F.sum("n").alias("n"))
    counts = Counts(counted.toArrow())
    keys = ["dim", "block", "cell", "i", "j", "visitors"]
    dealt = packed.mapInArrow(_place(cosine, grids, counts), "dim int, block int, cell long, i int, j int, visitors int, role int, id long, weight long, vector binary")
    found = written(dealt.groupBy(*keys).applyInArrow(_join(cosine), "id long, n long, root long"), "vector-links")
    linked = written(found.groupBy("id").agg(F.sum("n").alias("n")), "link-counts")
    rooted = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).join(reps.select("id", "first"), F.col("node") == F.col("id")).select("node", "root", "first")
    least = rooted.groupBy(F.col("root").alias("top")).agg(F.min("first").alias("first"))
    of_node = written(rooted.select("node", "root").join(least, F.col("root") == F.col("top")).select("node", "first"), "vector-components")
    discard(found)
    out = reps.select("s1", "s2", "id", "weight", F.col("first").alias("own")).join(linked, "id", "left").join(of_node, F.col("id") == F.col("node"), "left")
    out = out.select("s1", "s2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), F.coalesce("first", "own")["key"].alias("component_id"))
    joined = valid.select("key", "s1", "s2").join(out, ["s1", "s2"]).select("key", "n_links", "component_id")
    alone = keyed.where("vector is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return joined.union(alone).select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def _pack(kind: type):
    """Vectors as bytes of floats, if they came so, or doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(kind)
            ends = np.concatenate([[0], np.cumsum(batch.column("dim").to_numpy())]).tolist()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "weight", "dim")), pa.array([values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())], names=["id", "weight", "dim", "vector"])

    return run
