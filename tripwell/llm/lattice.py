"""Near-duplicate vectors by lattice hashing.

A vector is scaled to length one and projected, in each of several tables, to eight
dimensions; the point is decoded to the nearest point of the E8 lattice. That cell is
the vector's home in the table. It also probes the neighbouring cells (the 240
shortest steps of the lattice) whose points lie nearest. Two vectors meet where one
probes the other's home, and every meeting is verified by the cosine in double
precision, so no link below the threshold is reported; what is missed are links whose
vectors meet in no table (the tests measure recall at the threshold itself).

* Equal vectors collapse to one representative with a weight before any of this.
* A pair may meet in several tables. It counts in the first one, which both
  vectors' cells tell without looking at other tables.
* A cell with many homes or probes is split into a grid of blocks, each a task's
  unit of work, so a cell that holds a third of all vectors is shared by many tasks.
* Out of a block come, per vector, the weight of its links there, and a spanning
  forest of the links: never the pairs.

Vectors that are null, empty, zero, or hold null or non-finite components, and those
without an id, link with nothing. Vectors of different length do not link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.llm.components import connected_components
from tripwell.llm.neighbours import usable
from tripwell.sources.storage import store

TABLES, PROBES, SCALE = 5, 6, 1.3
BLOCK = 2048
HOT_CELLS = 100_000
PAIRS = 100_000


def _steps() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of 1 or -1, or all 1/2 or -1/2 with an even number of minus."""
    rows = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            rows.append(v)
    rows += [np.array(s) for s in product((0.5, -0.5), repeat=8) if np.prod(np.sign(s)) > 0]
    return np.array(rows)


STEPS = _steps()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the even integer points and their shift by one half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    whole[closer] = half[closer]
    return whole


def _projection(table: int, dim: int) -> np.ndarray:
    return np.random.default_rng([table, dim]).standard_normal((dim, 8))


def _cell(points: np.ndarray, table: int, dim: int) -> np.ndarray:
    """A 64-bit name of lattice points of one table."""
    mixed = np.full(points.shape[:-1], (table * 1_000_003 + dim) & 0xFFFFFFFF, np.uint64)
    for k in range(8):
        mixed = (mixed ^ np.rint(points[..., k] * 2).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def cells(units: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """Cells of unit vectors, of shape (vectors, tables, 1 + probes), the home first."""
    dim = units.shape[1]
    found = np.empty((len(units), tables, 1 + probes), np.int64)
    for t in range(tables):
        x = units @ _projection(t, dim) / scale
        home = decode(x)
        found[:, t, 0] = _cell(home, t, dim)
        if probes:
            along = (x - home) @ STEPS.T
            best = np.argpartition(-along, probes, axis=1)[:, :probes]
            found[:, t, 1:] = _cell(home[:, None, :] + STEPS[best], t, dim)
    return found


def _meetings(mine: np.ndarray, theirs: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether ``table`` is the first where one of a pair probes the other's home, and whether ``theirs`` probes mine there."""
    probing = (mine == theirs[:, :, :1]).any(axis=2)
    probed = (theirs == mine[:, :, :1]).any(axis=2)
    first = (probing | probed).argmax(axis=1)
    return first == table, probed[np.arange(len(first)), first]


def _links(homes: dict, probes: dict, threshold: float, settings: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (probing, home) of positions that link and are counted in this cell."""
    a, b, table = probes["vector"], homes["vector"], homes["table"]
    found_i, found_j = [], []
    step = max(1, PAIRS // max(1, len(b)))
    for at in range(0, len(a), step):
        near = a[at:at + step] @ b.T >= threshold - 1e-6
        i, j = np.nonzero(near)
        i = i + at
        keep = probes["id"][i] != homes["id"][j]
        i, j = i[keep], j[keep]
        dots = np.einsum("ij,ij->i", probes["raw"][i], homes["raw"][j])
        keep = dots / (probes["norm"][i] * homes["norm"][j]) >= threshold
        found_i.append(i[keep])
        found_j.append(j[keep])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    counted = np.zeros(len(i), bool)
    if len(i):
        used_i, at_i = np.unique(i, return_inverse=True)
        used_j, at_j = np.unique(j, return_inverse=True)
        cells_i, cells_j = cells(a[used_i], *settings), cells(b[used_j], *settings)
        for at in range(0, len(i), PAIRS):
            part = slice(at, at + PAIRS)
            here, both = _meetings(cells_i[at_i[part]], cells_j[at_j[part]], table)
            # where each probes the other's home, the pair counts in the home of the smaller id
            counted[part] = here & (~both | (homes["id"][j[part]] < probes["id"][i[part]]))
    return i[counted], j[counted]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge per node that connect what the edges (a, b) connect."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        u, v = label[x], label[y]
        apart = u != v
        if not apart.any():
            break
        x, y, u, v = x[apart], y[apart], u[apart], v[apart]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(label, up := label[label]):
            label = up
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


_EXPANDED = "cell long, role int, table int, id long, weight long, vector binary"


def _expanded(rows: DataFrame, settings: tuple, vectors: bool) -> DataFrame:
    """One row per home (role 0) and probe (role 1) of every representative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                dims = np.array([len(v) for v in batch.column("vector")])
                for dim in np.unique(dims).tolist():
                    some = batch.filter(pa.array(dims == dim))
                    raw = some.column("vector").flatten().to_numpy().reshape(-1, dim)
                    exact = raw.astype(np.float64)
                    found = cells(exact / np.linalg.norm(exact, axis=1)[:, None], *settings)
                    n, tables, each = found.shape
                    rep = lambda x: np.repeat(x, tables * each)
                    made = {"cell": found.ravel(), "role": np.tile((np.arange(each) > 0).astype(np.int32), n * tables)}
                    # a home is probed by its own vector too, so that vectors of one cell meet
                    own = found[:, :, 0].ravel()
                    made = {k: np.concatenate([v, w]) for (k, v), w in zip(made.items(), (own, np.ones(len(own), np.int32)))}
                    made["table"] = np.concatenate([np.tile(np.repeat(np.arange(tables), each), n),
                                                    np.tile(np.arange(tables), n)]).astype(np.int32)
                    ids, weights = some.column("id").to_numpy(), some.column("weight").to_numpy()
                    made["id"] = np.concatenate([rep(ids), np.repeat(ids, tables)])
                    made["weight"] = np.concatenate([rep(weights), np.repeat(weights, tables)])
                    order = np.arange(n)
                    index = np.concatenate([rep(order), np.repeat(order, tables)])
                    payload = [v.tobytes() for v in raw] if vectors else [b""] * n
                    for start in range(0, len(index), 5000):
                        part = slice(start, start + 5000)
                        yield pa.RecordBatch.from_pydict({
                            **{k: v[part] for k, v in made.items()},
                            "vector": pa.array([payload[i] for i in index[part].tolist()], pa.binary())})

    return rows.mapInArrow(run, _EXPANDED)


def _split_hot(rows: DataFrame, keys: DataFrame, block: int) -> DataFrame:
    """Adds the block coordinates (h, p); only cells beyond a block have more than one."""
    counts = keys.groupBy("cell").agg(F.sum((F.col("role") == 0).cast("long")).alias("homes"),
                                      F.sum("role").alias("probes"))
    hot = store(counts.where((F.col("homes") > block) | (F.col("probes") > 4 * block)).select(
        "cell", F.ceil(F.col("homes") / block).alias("kh"), F.ceil(F.col("probes") / (4 * block)).alias("kp")), "hot-cells")
    if hot.limit(HOT_CELLS + 1).count() <= HOT_CELLS:
        hot = F.broadcast(hot)
    salt = F.xxhash64("id")
    kh, kp = F.greatest(F.coalesce("kh", F.lit(1)), F.lit(1)), F.greatest(F.coalesce("kp", F.lit(1)), F.lit(1))
    marked = rows.join(hot, "cell", "left").withColumns({
        "hs": F.when(F.col("role") == 0, F.array(F.pmod(salt, kh))).otherwise(F.sequence(F.lit(0).cast("long"), kh - 1)),
        "ps": F.when(F.col("role") == 1, F.array(F.pmod(salt, kp))).otherwise(F.sequence(F.lit(0).cast("long"), kp - 1))})
    return marked.withColumn("h", F.explode("hs")).withColumn("p", F.explode("ps")).drop("hs", "ps", "kh", "kp")


def _verified(rows: DataFrame, threshold: float, settings: tuple, kind: str) -> DataFrame:
    """Per block: (id, n, null) with link weights, and (id, 0, root) with forest edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(parts):
            whole = pa.Table.from_batches(parts)
            role = whole["role"].to_numpy()
            if not (0 < (n := int((role == 0).sum())) < len(role)):
                return
            sides = {}
            for r in (0, 1):
                some = whole.slice(0, n) if r == 0 else whole.slice(n)
                raw = np.frombuffer(b"".join(some["vector"].to_pylist()), kind).reshape(some.num_rows, -1).astype(np.float64)
                norm = np.linalg.norm(raw, axis=1)
                sides[r] = {"id": some["id"].to_numpy(), "weight": some["weight"].to_numpy(), "raw": raw,
                            "norm": norm, "vector": raw / norm[:, None], "table": whole["table"][0].as_py()}
            i, j = _links(sides[0], sides[1], threshold, settings)
            if not len(i):
                return
            a, b = sides[1]["id"][i], sides[0]["id"][j]
            ends, weights = np.concatenate([a, b]), np.concatenate([sides[0]["weight"][j], sides[1]["weight"][i]])
            ids, at = np.unique(ends, return_inverse=True)
            sums = np.zeros(len(ids), np.int64)
            np.add.at(sums, at, weights)
            x, y = _forest(a, b)
            yield pa.RecordBatch.from_pydict({
                "id": np.concatenate([ids, x]), "n": np.concatenate([sums, np.zeros(len(x), np.int64)]),
                "root": pa.array([None] * len(ids) + y.tolist(), pa.int64())})

        key, parts = None, []
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("cell", "h", "p")]
            change = np.zeros(max(0, batch.num_rows - 1), bool)
            for c in columns:
                change |= np.diff(c) != 0
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                now = tuple(int(c[a]) for c in columns)
                if key is not None and now != key:
                    yield from done(parts)
                    parts = []
                key = now
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from done(parts)

    return (rows.repartition("cell", "h", "p").sortWithinPartitions("cell", "h", "p", "role", "id")
            .mapInArrow(run, "id long, n long, root long"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_column: str = "vec_id", vector: str = "embedding",
                    tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id and kept (whether it names its component).

    Rows are vectors of their own, also when they repeat an id.
    """
    settings = (tables, probes, scale)
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"  # travels in its own width
    picked = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                            F.col(vector).cast("array<float>" if single else "array<double>").alias("vector"))
    good = F.col("vec_id").isNotNull() & usable(F.col("vector"))
    rows = picked.select("vec_id", "vector", *[F.when(good, F.xxhash64(F.lit(k), "vector")).alias(f"k{k}") for k in (1, 2)])
    # A node stands for a vector, not for an id: different vectors may share one.
    reps = store(rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("weight"), F.min("vector").alias("vector")).withColumn(
        "id", F.monotonically_increasing_id()), "representatives")
    expanded = _expanded(reps.select("id", "weight", "vector"), settings, True)
    keys = _expanded(reps.select("id", "weight", "vector"), settings, False)
    found = store(_verified(_split_hot(expanded, keys, block), threshold, settings, "<f4" if single else "<f8"), "links")
    counts = found.groupBy("id").agg(F.sum("n").alias("others"))
    roots = connected_components(found.where("root is not null"), "id", "root").withColumnsRenamed({"node": "id", "root": "top"})
    rooted = reps.select("k1", "k2", "id", "first_id", "weight").join(counts, "id", "left").join(roots, "id", "left").select(
        "k1", "k2", "first_id", F.coalesce("top", "id").alias("top"),
        (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    names = rooted.groupBy("top").agg(F.min("first_id").alias("component"))
    named = rooted.join(names, "top").select("k1", "k2", "links", "component")
    result = rows.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return result.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
