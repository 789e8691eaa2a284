"""Ranked lexical search: exact inner products over sparse ball trees.

A document is a sparse vector of term weights, an item a sparse vector of rarities,
and the score their inner product in integers.

1. Items are dealt into blocks of a bounded number of terms; each block makes its own
   pass, so what is broadcast never grows with the number of items. One pass over the
   texts counts the terms of a document and how often it holds terms of the block.
2. Sums over the stored counts give the number of documents, their terms and the
   document frequencies, over the whole table.
3. Every task turns its documents into vectors, a bounded number of entries at a time,
   and builds a ball tree over them: a node has the mean of its documents and the
   largest distance from it. The product with the mean plus the item's length times
   the radius bounds every score below the node; sums are rounded up by more than
   their error. Nodes are opened best-first, and a subtree goes when its bound is
   less than the item's k-th score so far. Leaves are scored in integers.
4. The best of the tasks are merged in two rounds, so that no task meets them all.

Nothing is approximate. Null, empty and termless texts count neither as documents nor
as items. Every row is a document or an item of its own, also where ids repeat or are
null; rows of items that share an id are ranked together, each document once for every
row that finds it. Equal scores go by ascending id, null last.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwell.llm.batches import slices
from tripwell.sources.storage import store

BLOCK_TERMS = 200_000
CHUNK_ENTRIES, LEAF = 1_000_000, 32
_NO_ID = 1 << 63
_SEPARATORS = bytes(b + 32 * (65 <= b <= 90) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased."""
    return (text or "").encode().translate(_SEPARATORS).split()


def rarity(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class BallTree:
    """A ball tree over sparse rows: (starts, terms, weights), rows being documents with at least one entry."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, leaf: int = LEAF):
        self.lengths = np.diff(starts)
        self.starts, self.terms, self.weights, self.leaf = starts, terms, weights, leaf
        self.values = weights.astype(np.float64)
        self.squares = np.add.reduceat(self.values * self.values, starts[:-1])
        self.order = np.arange(len(self.lengths))
        self.dense = np.zeros(int(terms.max()) + 1)
        self.nodes: list[tuple[int, int, int, int]] = []  # first and last row in order, children
        self.radius: list[float] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._build()
        self._finish()

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the rows' entries, and where each row's begin among them."""
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        return np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends + lengths, lengths), ends - lengths

    def _distances(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, cuts: np.ndarray,
                   to: tuple[np.ndarray, np.ndarray], square: float) -> np.ndarray:
        """Squared distances of rows to a sparse point, rounded up."""
        self.dense[to[0]] = to[1]
        products = np.add.reduceat(values * self.dense[terms], cuts)
        self.dense[to[0]] = 0
        sizes = self.squares[rows] + square
        return np.maximum(sizes - 2 * products, 0) + 1e-9 * sizes

    def _build(self) -> None:
        waiting = [(0, len(self.order), -1)]
        while waiting:
            first, last, parent = waiting.pop()
            rows = self.order[first:last]
            at, cuts = self._entries(rows)
            terms, values = self.terms[at], self.values[at]
            sums = np.bincount(terms, values)
            held = np.flatnonzero(sums)
            mean = sums[held] / len(rows)
            far = self._distances(rows, terms, values, cuts, (held, mean), float(mean @ mean))
            node = len(self.nodes)
            self.nodes.append((first, last, -1, -1))
            self.radius.append(math.sqrt(far.max()))
            self.parts.append((held, mean))
            if parent >= 0:
                a, b, left, _ = self.nodes[parent]
                self.nodes[parent] = (a, b, node, -1) if left < 0 else (a, b, left, node)
            if len(rows) <= self.leaf:
                continue
            self.order[first:last] = rows[self._split(rows, terms, values, cuts, far)]
            half = first + self.left
            waiting += [(first, half, node), (half, last, node)]

    def _split(self, rows, terms, values, cuts, far) -> np.ndarray:
        """An order of the rows whose first ``left`` go left: by which of two distant rows is nearer."""
        ends = np.append(cuts[1:], len(terms))
        gaps = []
        for _ in range(2):
            i = int(far.argmax())
            pivot = slice(cuts[i], ends[i])
            far = self._distances(rows, terms, values, cuts, (terms[pivot], values[pivot]), self.squares[rows[i]])
            gaps.append(far)
        lean = gaps[0] - gaps[1]
        order = np.argsort(lean, kind="stable")
        self.left = int((lean < 0).sum())
        if not len(rows) // 16 < self.left < len(rows) - len(rows) // 16:
            self.left = len(rows) // 2  # copies, or a lone outlier: halves keep the tree shallow
        return order

    def _finish(self) -> None:
        """Rows in tree order, and the means' entries by term."""
        at, cuts = self._entries(self.order)
        self.terms, self.weights = self.terms[at], self.weights[at]
        self.starts = np.append(cuts, len(at))
        terms = np.concatenate([t for t, _ in self.parts])
        order = np.argsort(terms, kind="stable")
        self.mean_nodes = np.repeat(np.arange(len(self.parts)), [len(t) for t, _ in self.parts])[order]
        self.mean_values = np.concatenate([v for _, v in self.parts])[order]
        self.mean_cuts = np.searchsorted(terms[order], np.arange(len(self.dense) + 1))
        self.radii = np.array(self.radius)
        del self.parts, self.values

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every node an integer that no score below it exceeds."""
        held = terms < len(self.dense)
        a, b = self.mean_cuts[terms[held]], self.mean_cuts[terms[held] + 1]
        at = np.concatenate([np.arange(x, y) for x, y in zip(a, b)] or [np.zeros(0, np.int64)]).astype(np.int64)
        near = np.bincount(self.mean_nodes[at], self.mean_values[at] * np.repeat(weights[held], b - a), len(self.radii))
        length = math.sqrt(float((weights.astype(np.float64) ** 2).sum()))
        return np.ceil((near + length * self.radii) * (1 + 1e-9)) + 1

    def scores(self, first: int, last: int, dense: np.ndarray) -> np.ndarray:
        a, b = self.starts[first], self.starts[last]
        return np.add.reduceat(dense[self.terms[a:b]] * self.weights[a:b], self.starts[first:last] - a)


class Ranking:
    """The best ``k`` documents of an item so far."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, k: int):
        self.terms, self.weights, self.k = terms, weights, k
        self.heap: list[tuple[int, int]] = []
        self.opened = 0

    def search(self, tree: BallTree, keys: list[int], dense: np.ndarray) -> None:
        dense[self.terms] = self.weights
        bounds = tree.bounds(self.terms, self.weights)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            least = self.heap[0][0] if len(self.heap) == self.k else 1
            if -bound < least:
                break
            first, last, left, right = tree.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= least:
                        heapq.heappush(queue, (max(bound, -bounds[child]), child))
                continue
            self.opened += 1
            found = tree.scores(first, last, dense)
            for i in np.flatnonzero(found >= least).tolist():
                entry = (int(found[i]), -keys[tree.order[first + i]])
                if len(self.heap) < self.k:
                    heapq.heappush(self.heap, entry)
                elif entry > self.heap[0]:
                    heapq.heapreplace(self.heap, entry)
        dense[self.terms] = 0


def _counted(docs: DataFrame, known, id_column: str, text: str) -> DataFrame:
    """(doc_id, n, terms, times) of every document that has a term; ``terms`` number those of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for ids, texts in slices(batches, "doc_id", "text"):
            rows = []
            for doc_id, t in zip(ids, texts):
                words = terms_of(t)
                if words:
                    held = [x for x in map(numbers.get, words) if x is not None]
                    rows.append((doc_id, len(words), *np.unique(np.array(held, np.int32), return_counts=True)))
            columns = list(zip(*rows)) or [()] * 4
            cuts = pa.array(np.cumsum([0, *map(len, columns[2])]), pa.int32())
            flat = [pa.array(np.concatenate([np.zeros(0, np.int32), *c]).astype(np.int32)) for c in columns[2:]]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(columns[0], pa.int64()), "n": pa.array(columns[1], pa.int64()),
                **{name: pa.ListArray.from_arrays(cuts, f) for name, f in zip(("terms", "times"), flat)}})

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def _best(counted: DataFrame, given, k: int) -> DataFrame:
    """(item, doc_id, score, lane): the best ``k`` of every task for every item of the block."""
    def search(chunk: list[tuple], rankings: list[Ranking], value: dict, dense: np.ndarray) -> None:
        ids, sizes, terms, times = zip(*chunk)
        lengths = np.array([len(t) for t in terms])
        m = np.array([100 - 90 + (90 * n * value["documents"]) // value["words"] for n in sizes], np.int64)
        tf = np.concatenate(times).astype(np.int64)
        weights = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, lengths))
        tree = BallTree(np.concatenate([[0], np.cumsum(lengths)]), np.concatenate(terms), weights)
        keys = [_NO_ID if i is None else i for i in ids]
        for r in rankings:
            r.search(tree, keys, dense)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = given.value
        dense = np.zeros(len(value["rarity"]), np.int64)
        rankings = [Ranking(t, value["rarity"][t], k) for t in value["items"]]
        chunk, entries = [], 0
        for batch in batches:
            cuts = [batch.column(c).offsets.to_numpy() for c in ("terms", "times")]
            flat = [batch.column(c).values.to_numpy() for c in ("terms", "times")]
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist())
            for i, (doc_id, n) in enumerate(rows):
                (a, b), (c, d) = cuts[0][i:i + 2], cuts[1][i:i + 2]
                chunk.append((doc_id, n, flat[0][a:b].copy(), flat[1][c:d].copy()))
                entries += b - a
                if entries >= CHUNK_ENTRIES:
                    search(chunk, rankings, value, dense)
                    chunk, entries = [], 0
        if chunk:
            search(chunk, rankings, value, dense)
        found = [(i, None if key == -_NO_ID else -key, score) for i, r in enumerate(rankings) for score, key in r.heap]
        columns = list(zip(*found)) or [()] * 3
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(columns[0], pa.int32()), "doc_id": pa.array(columns[1], pa.int64()),
            "score": pa.array(columns[2], pa.int64()),
            "lane": pa.array([TaskContext.get().partitionId() % 64] * len(found), pa.int32())})

    return counted.where(F.size("terms") > 0).mapInArrow(run, "item int, doc_id long, score long, lane int")


def _first(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _item_blocks(items: DataFrame, id_column: str, text: str, most: int) -> tuple[DataFrame, int]:
    """Items with their distinct terms and a block each, the number of blocks being so that each is small."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, "item_id", "text"):
            terms = [sorted(set(terms_of(t))) for t in texts]
            yield pa.RecordBatch.from_pydict({"item_id": pa.array(ids, pa.int64()),
                                              "terms": pa.array(terms, pa.list_(pa.binary()))})

    picked = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text).alias("text"))
    rows = store(picked.mapInArrow(run, "item_id long, terms array<binary>").where(F.size("terms") > 0).withColumn(
        "deal", F.xxhash64(F.monotonically_increasing_id())), "items")
    blocks = 1
    while True:
        block = F.pmod("deal", F.lit(blocks)).cast("int")
        sizes = rows.groupBy(block.alias("block")).agg(F.sum(F.size("terms")).alias("terms"), F.count("*").alias("items"))
        full = sizes.agg(F.max(F.when(F.col("items") > 1, F.col("terms")))).first()[0] or 0
        if full <= most:
            return rows.withColumn("block", block), blocks
        blocks *= max(2, -(-full // most))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text: str = "text",
           item_column: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 of every item."""
    spark = docs.sparkSession
    blocked, blocks = _item_blocks(items, item_column, item_text, block_terms)
    results = []
    for b in range(blocks):
        rows = blocked.where(F.col("block") == b).select("item_id", "terms").collect()
        if not rows:
            continue
        names = sorted({bytes(t) for r in rows for t in r.terms})
        numbers = {t: i for i, t in enumerate(names)}
        counted = store(_counted(docs, spark.sparkContext.broadcast(numbers), id_column, text), "terms")
        total = counted.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        frequency = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        given = spark.sparkContext.broadcast({
            "documents": total.documents, "words": max(1, total.words),
            "rarity": np.array([rarity(total.documents, frequency.get(i, 0)) for i in range(len(names))], np.int64),
            "items": [np.array([numbers[bytes(t)] for t in r.terms], np.int64) for r in rows]})
        named = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id long")
        merged = _first(_first(_best(counted, given, k), k, "item", "lane"), k, "item").drop("rank")
        results.append(store(merged.join(F.broadcast(named), "item").select("item_id", "doc_id", "score"), "ranked"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for r in results[1:]:
        whole = whole.union(r)
    return _first(whole, k, "item_id").select("item_id", "rank", "doc_id", "score")


def term_pattern() -> str:
    return r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def oracle(k: int = 10) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term_pattern()}')"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
    sized AS (SELECT r, doc_id, len(words) AS n FROM docs WHERE len(words) > 0),
    total AS (SELECT count(*) AS docs_n, sum(n)::BIGINT AS words_n FROM sized),
    wanted AS (SELECT DISTINCT item_id, unnest({words}) AS term FROM benchmark),
    counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM docs)
               WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
    rarity AS (SELECT term, floor(1000 * ln((2 * any_value(docs_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w
               FROM counts, total GROUP BY term),
    scored AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs_n) // words_n))))::BIGINT AS score
               FROM wanted JOIN counts USING (term) JOIN rarity USING (term) JOIN sized USING (r), total
               GROUP BY item_id, doc_id, r)
    SELECT item_id, rank, doc_id, score FROM (
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0) WHERE rank <= {k}
    """
