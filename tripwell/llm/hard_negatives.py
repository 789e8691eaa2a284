"""Hard negatives by angular triangle filtering.

Components become integers, and a row's score for an anchor is the integer inner
product. An anchor's positives are its best rows of the same label; a positive's hard
negatives are the best rows of other labels whose score lies in a band below it.

1. Rows are dealt evenly into lanes. A lane is stored as one row of packed columns,
   sorted by label and nearest reference direction, with the angle of every row to
   every reference direction and its norm.
2. All anchors visit all lanes in blocks: anchors travel, rows stay. By the triangle
   inequality on the sphere the angle between anchor and row lies between the largest
   difference and the smallest sum of their angles to a reference. Cosines of these
   limits times both norms bound the score; angles and products are widened by more
   than their rounding. Cells of neighbouring rows are tried first by the extremes of
   their angles, then single rows by their own.
3. Only rows whose bounds reach into the wanted window are scored, in integers. The
   window's lower end rises to the k-th best found so far.
4. Lanes' best are merged: first positives, which set the windows, then negatives.

Results are exact. Rows with a null label, a null vector, or a null or non-finite
component take no part; neither do rows with a component of 2**53 / scale or more,
which has no exact integer, nor pairs whose score exceeds 64 bits. Vectors of
different length never meet. Every row is a row of its own, also where ids repeat; an
anchor without rows of its label, or a positive of negative score, gives no rows.
Equal scores go by ascending id, null last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwell.llm.batches import hand_back
from tripwell.sources.storage import store

SCALE, REFERENCES, CELL = 256, 16, 64
SAMPLE = 2000
LANE_BYTES = 16 << 20
ANGLE_SLACK = 2e-5
_LIMIT = 1 << 53


def directions(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` unit vectors: those of the sample that are farthest from each other, then random ones."""
    dim = sample.shape[1]
    lengths = np.linalg.norm(sample, axis=1) if dim else np.zeros(0)
    units = sample[lengths > 0] / lengths[lengths > 0][:, None]
    picked = []
    if len(units):
        near = np.full(len(units), -2.0)
        at = 0
        while len(picked) < n and near.min() < 1 - 1e-6:
            picked.append(units[at])
            near = np.maximum(near, units @ units[at])
            at = int(near.argmin())
    rest = np.random.default_rng(dim).standard_normal((n - len(picked), dim))
    if dim:
        rest /= np.linalg.norm(rest, axis=1)[:, None]
    return np.concatenate([np.array(picked).reshape(len(picked), dim), rest])


def angles_to(references: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Angles of rows to the references, single precision; rows of length zero count as orthogonal."""
    cosines = (vectors @ references.T) / np.maximum(norms, 1e-300)[:, None]
    return np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


def score_bounds(low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray,
                 angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of rows whose angles lie in [low, high] and norms in [least, most].

    The first two have a column for each reference; for single rows they are the same.
    """
    near = np.maximum(np.maximum(low - angles, angles - high), 0).max(axis=1).astype(np.float64)
    first, last = low + angles, high + angles
    far = np.where(last <= np.pi, last, np.where(first >= np.pi, 2 * np.pi - first, np.pi)).min(axis=1).astype(np.float64)
    top = np.cos(np.clip(near - ANGLE_SLACK, 0, np.pi)) * norm
    bottom = np.cos(np.clip(far + ANGLE_SLACK, 0, np.pi)) * norm
    slack = 1 + 1e-9 * norm * most
    return (np.floor(np.where(bottom >= 0, bottom * least, bottom * most) - slack),
            np.ceil(np.where(top >= 0, top * most, top * least) + slack))


class Lane:
    """Rows of one lane, in the order they were packed."""

    def __init__(self, row: dict):
        self.n, self.dim = row["n"], row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.no_id = np.frombuffer(row["no_id"], bool)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(self.n, self.dim).astype(np.float64)
        self.norms = np.frombuffer(row["norms"], np.float64)
        self.angles = np.frombuffer(row["angles"], np.float32).reshape(self.n, -1)
        self.largest = np.abs(self.vectors).max(initial=0)
        edge = np.flatnonzero(np.diff(self.labels)) + 1
        self.cuts = np.unique(np.concatenate([np.arange(0, self.n, CELL), edge, [self.n]]))
        starts = self.cuts[:-1]
        self.cell_labels = self.labels[starts]
        self.cell_low = np.minimum.reduceat(self.angles, starts)
        self.cell_high = np.maximum.reduceat(self.angles, starts)
        self.cell_least = np.minimum.reduceat(self.norms, starts)
        self.cell_most = np.maximum.reduceat(self.norms, starts)

    def cells(self, wanted: np.ndarray, anchor: "Anchor") -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(self.cell_low[wanted], self.cell_high[wanted], self.cell_least[wanted],
                            self.cell_most[wanted], anchor.angles, anchor.norm)

    def rows_of(self, cells: np.ndarray) -> np.ndarray:
        a, b = self.cuts[cells], self.cuts[cells + 1]
        ends = np.cumsum(b - a)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(b - ends, b - a)

    def rows(self, wanted: np.ndarray, anchor: "Anchor") -> tuple[np.ndarray, np.ndarray]:
        angles, norms = self.angles[wanted], self.norms[wanted]
        return score_bounds(angles, angles, norms, norms, anchor.angles, anchor.norm)

    def score(self, wanted: np.ndarray, anchor: "Anchor") -> np.ndarray:
        """Exact inner products; doubles where all partial sums are exact integers, else Python's integers."""
        if self.dim * self.largest * anchor.largest < _LIMIT:
            return (self.vectors[wanted] @ anchor.vector).astype(np.int64)
        there = [int(x) for x in anchor.vector]
        found = [sum(int(x) * y for x, y in zip(v, there)) for v in self.vectors[wanted]]
        return np.array([s if -(1 << 63) < s < 1 << 63 else -(1 << 63) for s in found], np.int64)

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Positions of the ``k`` best by score, then id."""
        if len(scores) > 4 * k:
            floor = np.partition(scores, len(scores) - k)[len(scores) - k]
            some = np.flatnonzero(scores >= floor)
        else:
            some = np.arange(len(scores))
        order = np.lexsort((self.ids[rows[some]], self.no_id[rows[some]], -scores[some]))
        return some[order[:k]]


class Anchor:
    """One anchor with what later steps need to name it."""

    def __init__(self, row: dict):
        self.lane, self.place, self.anchor_id, self.label = row["lane"], row["place"], row["anchor_id"], row["label"]
        self.vector = np.frombuffer(row["vector"], np.float64)
        self.angles = np.frombuffer(row["angles"], np.float32)
        self.norm = row["norm"]
        self.largest = np.abs(self.vector).max(initial=0)
        self.windows = [tuple(w.values()) for w in row.get("windows") or []]


def positives_in(lane: Lane, number: int, anchor: Anchor, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the best ``k`` other rows of the anchor's label."""
    cells = np.flatnonzero(lane.cell_labels == anchor.label)
    if not len(cells):
        return cells, cells
    low, high = lane.cells(cells, anchor)
    cells, high = (x[np.argsort(-high, kind="stable")] for x in (cells, high))
    head = min(len(cells), -(-k // CELL) + 1)

    def others(rows):
        return rows[rows != anchor.place] if number == anchor.lane else rows

    rows = others(lane.rows_of(cells[:head]))
    scores = lane.score(rows, anchor)
    if len(cells) > head:
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -(1 << 63)
        more = others(lane.rows_of(cells[head:][high[head:] >= least]))
        if len(more):
            more = more[lane.rows(more, anchor)[1] >= least]
            rows, scores = np.concatenate([rows, more]), np.concatenate([scores, lane.score(more, anchor)])
    kept = scores != -(1 << 63)
    rows, scores = rows[kept], scores[kept]
    picked = lane.best(rows, scores, k)
    return rows[picked], scores[picked]


def negatives_in(lane: Lane, anchor: Anchor, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every window (positive rank, lowest, highest score): rows and scores of the best ``k`` of other labels."""
    cells = np.flatnonzero(lane.cell_labels != anchor.label)
    if not len(cells) or not anchor.windows:
        return
    low, high = lane.cells(cells, anchor)
    bottom, top = (np.array([w[i] for w in anchor.windows]) for i in (1, 2))
    # A few cells near the upper end of the windows raise the lower ends.
    near = np.argsort(np.abs(high - top.max()), kind="stable")[:-(-k // CELL) + 3]
    seeds = lane.rows_of(np.sort(cells[near]))
    scores = lane.score(seeds, anchor)
    least = bottom.copy()
    for i, (a, b) in enumerate(zip(bottom, top)):
        inside = scores[(scores >= a) & (scores <= b)]
        if len(inside) >= k:
            least[i] = np.partition(inside, len(inside) - k)[len(inside) - k]

    def reaches(lows, highs):
        return np.any((highs[:, None] >= least) & (lows[:, None] <= top), axis=1)

    other = np.ones(len(cells), bool)
    other[near] = False
    rows = lane.rows_of(cells[other & reaches(low, high)])
    if len(rows):
        rows = rows[reaches(*lane.rows(rows, anchor))]
        scores = np.concatenate([scores, lane.score(rows, anchor)])
        seeds = np.concatenate([seeds, rows])
    for i, (rank, a, b) in enumerate(anchor.windows):
        inside = np.flatnonzero((scores >= least[i]) & (scores <= b))
        if len(inside):
            picked = inside[lane.best(seeds[inside], scores[inside], k)]
            yield rank, seeds[picked], scores[picked]


_LANES = ("dim int, lane int, n int, kind string, ids binary, no_id binary, labels binary, anchors binary, "
          "vectors binary, norms binary, angles binary")


def _packed(rows: DataFrame, references) -> DataFrame:
    """One row per lane, its rows sorted by label, nearest reference and angle to it."""
    def made(dim: int, lane: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, no_id, labels, anchors, vectors = (np.concatenate(p) for p in zip(*parts))
        vectors = vectors.reshape(len(ids), dim)
        norms = np.linalg.norm(vectors, axis=1)
        angles = angles_to(references.value.get(dim, directions(np.zeros((0, dim)), REFERENCES)), vectors, norms)
        nearest = angles.argmin(axis=1) if len(ids) else np.zeros(0, int)
        order = np.lexsort((angles[np.arange(len(ids)), nearest], nearest, labels))
        largest = np.abs(vectors).max(initial=0)
        kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<f8"
        packed = {"ids": ids, "no_id": no_id, "labels": labels, "anchors": anchors, "vectors": vectors.astype(kind),
                  "norms": norms, "angles": angles}
        return pa.RecordBatch.from_pydict({
            "dim": pa.array([dim], pa.int32()), "lane": pa.array([lane], pa.int32()),
            "n": pa.array([len(ids)], pa.int32()), "kind": pa.array([kind]),
            **{name: pa.array([x[order].tobytes()], pa.binary()) for name, x in packed.items()}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            dims, lanes = (batch.column(c).to_numpy() for c in ("dim", "lane"))
            cuts = [0, *(np.flatnonzero((np.diff(dims) != 0) | (np.diff(lanes) != 0)) + 1).tolist(), len(dims)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                now = (int(dims[a]), int(lanes[a]))
                if key is not None and now != key:
                    yield made(*key, parts)
                    parts = []
                key = now
                ids = batch.column("id")[a:b]
                parts.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                              batch.column("label")[a:b].to_numpy(),
                              batch.column("anchor")[a:b].to_numpy(zero_copy_only=False),
                              batch.column("vector")[a:b].flatten().to_numpy()))
        if key is not None:
            yield made(*key, parts)
        hand_back()

    return rows.mapInArrow(run, _LANES)


def _anchors(lanes: DataFrame) -> DataFrame:
    """(dim, lane, place, anchor_id, label, vector, angles, norm) of every anchor; lane and place name its row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lane = Lane(row)
                at = np.flatnonzero(np.frombuffer(row["anchors"], bool))
                for i in range(0, len(at), 256):
                    part = at[i:i + 256]
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([row["dim"]] * len(part), pa.int32()),
                        "lane": pa.array([row["lane"]] * len(part), pa.int32()), "place": pa.array(part, pa.int32()),
                        "anchor_id": pa.array(lane.ids[part], pa.int64(), mask=lane.no_id[part]),
                        "label": pa.array(lane.labels[part], pa.int64()),
                        "vector": pa.array([lane.vectors[j].tobytes() for j in part], pa.binary()),
                        "angles": pa.array([lane.angles[j].tobytes() for j in part], pa.binary()),
                        "norm": pa.array(lane.norms[part], pa.float64())})

    return lanes.mapInArrow(run, "dim int, lane int, place int, anchor_id long, label long, vector binary, angles binary, norm double")


def _visit(lanes: DataFrame, anchors: DataFrame, n_lanes: int,
           look: Callable[[Lane, int, Anchor], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> DataFrame:
    """(dim, lane, place, anchor_id, rank, id, score) for every anchor and every lane of its dimension."""
    given = anchors.columns
    kinds = dict(anchors.dtypes)
    visits = anchors.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(n_lanes - 1)))).select(
        "dim", F.col("to").alias("at"), F.lit(1).alias("turn"), F.struct(*given).alias("visitor"),
        F.lit(None).cast("struct<" + _LANES.replace(" ", ":").replace(",:", ",") + ">").alias("home"))
    homes = lanes.select("dim", F.col("lane").alias("at"), F.lit(0).alias("turn"),
                         F.lit(None).cast("struct<" + ",".join(f"{c}:{kinds[c]}" for c in given) + ">").alias("visitor"),
                         F.struct(*lanes.columns).alias("home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lane = None, None
        found = []

        def emptied() -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 7
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            names = ("dim", "lane", "place", "anchor_id", "rank", "id", "score")
            made = pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})
            found.clear()
            return made

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("dim", "at", "turn")]
            for i, (dim, at, turn) in enumerate(zip(*columns)):
                if turn == 0:
                    key, lane = (dim, at), Lane(batch.column("home")[i].as_py())
                elif key == (dim, at):
                    anchor = Anchor(batch.column("visitor")[i].as_py())
                    for rank, rows, scores in look(lane, at, anchor):
                        ids = [None if n else i for i, n in zip(lane.ids[rows].tolist(), lane.no_id[rows].tolist())]
                        found += [(dim, anchor.lane, anchor.place, anchor.anchor_id, rank, i, s) for i, s in zip(ids, scores.tolist())]
                    if len(found) > 5000:
                        yield emptied()
        yield emptied()
        lane = None
        hand_back()

    met = homes.union(visits).repartition(n_lanes, "dim", "at").sortWithinPartitions("dim", "at", "turn")
    return met.mapInArrow(run, "dim int, lane int, place int, anchor_id long, rank int, id long, score long")


def mine(vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, k: int = 10,
         band: tuple[int, int] = (30, 90), id_column: str = "vec_id", vector: str = "embedding",
         scale: int = SCALE, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` and ``label`` are stated on the columns of ``vectors``; the label is an
    integer. ``band`` are the percentages of the positive's score between which a
    negative's must lie.
    """
    spark = vectors.sparkSession
    whole = F.col(vector).cast("array<double>")
    picked = vectors.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
                            F.coalesce(is_anchor, F.lit(False)).alias("anchor"), whole.alias("vector"))
    exact = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < _LIMIT / scale)), F.lit(False))
    rows = picked.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & exact).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double"))).withColumn("dim", F.size("vector"))
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(8 * F.col("dim") + 8 * REFERENCES), F.lit(0)).alias("bytes")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not total.n:
        return spark.createDataFrame([], schema)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_lanes = max(-(-total.bytes // lane_bytes), min(parallel, -(-total.n // 1024)))
    # The directions only decide how tight the bounds are: those of a bounded sample will do.
    sample: dict[int, list] = {}
    for r in rows.select("dim", "vector").orderBy(F.xxhash64("id", "vector")).limit(SAMPLE).collect():
        sample.setdefault(r.dim, []).append(r.vector)
    references = spark.sparkContext.broadcast({d: directions(np.array(v, np.float64).reshape(len(v), d), REFERENCES)
                                               for d, v in sample.items()})
    dealt = rows.withColumn("lane", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_lanes)).cast("int"))
    lanes = store(_packed(dealt.repartition("dim", "lane").sortWithinPartitions("dim", "lane"), references), "lanes")
    anchors = _anchors(lanes)

    def of_same_label(lane: Lane, number: int, anchor: Anchor):
        found, scores = positives_in(lane, number, anchor, n_positives)
        yield 0, found, scores

    def of_other_labels(lane: Lane, number: int, anchor: Anchor):
        yield from negatives_in(lane, anchor, k)

    place = ["dim", "lane", "place"]
    order = [F.desc("score"), F.asc_nulls_last("id")]
    near = _visit(lanes, anchors, n_lanes, of_same_label).drop("rank")
    best = store(near.withColumn("rank", F.row_number().over(Window.partitionBy(*place).orderBy(*order))).where(
        F.col("rank") <= n_positives), "positives")
    low, high = band

    def share(percent: int, more: int) -> Column:
        return F.expr(f"(score div 100) * {percent} + ((score % 100) * {percent} + {more}) div 100")

    windows = best.where("score >= 0").withColumn("low", share(low, 99)).withColumn("high", share(high, 0)).groupBy(*place).agg(
        F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("windows"))
    found = _visit(lanes, anchors.join(windows, place), n_lanes, of_other_labels)
    ranked = found.withColumn("n", F.row_number().over(Window.partitionBy(*place, "rank").orderBy(*order))).where(F.col("n") <= k)
    named = best.select(*place, "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(named, [*place, "rank"]).select(
        "anchor_id", "positive_id", F.col("n").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def oracle(positives: int = 5, k: int = 10) -> str:
    return f"""
    WITH rows AS (
        SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.r AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_dot_product(a.v, b.v)::BIGINT AS score
        FROM rows a JOIN rows b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT a, id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= {positives}),
    fitting AS (
        SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY a, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM pairs JOIN positives USING (a)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
    SELECT * FROM fitting WHERE rank <= {k}
    """
