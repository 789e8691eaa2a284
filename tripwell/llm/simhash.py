"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

Copies collapse first: only different fingerprints are compared. A fingerprint's
tile is the pair of population counts of its two halves, in bins for a wide radius. Every flipped bit moves
one of the two counts by one, so tiles whose counts differ by more than the radius
in sum cannot hold a link and are never brought together. Tiles beyond a block size
are split by a hash, and every pair of blocks that may hold a link is one unit of
work: a numpy exclusive-or and bit count of all their fingerprints, in strips.

From each pair of blocks only a spanning forest of its links leaves the task, at
most one edge per fingerprint. Large groups of near copies therefore cost no more
rows than they have members, and no link is lost for the components.

The comparison is exact, so its time grows with the square of the number of
different fingerprints, divided by what the tiles save.

:func:`deduplicate` takes fingerprints only as candidates. Its nodes are different
sets of shingles, tiled by size, and bounds wide enough for the wanted similarity
give candidate components. Inside these the sets themselves are compared, in blocks
of a bounded number of shingles, and only links of that similarity join a class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripwell.llm.batches import handing_back
from tripwell.llm.components import connected_components
from tripwell.llm.substrings import FILTER_BITS, HOT_SHARDS, _bit_filter
from tripwell.sources.storage import store

BLOCK = 8192
BLOCK_SHINGLES = 1 << 20
STRIP = 1 << 20
BATCH_BYTES = 4 << 20
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8) * 256)[None, :]
_MIXERS = (np.arange(4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xD6E8FEB86659FD93) | np.uint64(1)
_WEIGHTS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: str | None, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """Hashes of all word shingles of the lower-cased text, repeats included; none without words.

    Only A-Z are lowered, words are separated by ASCII white space, and a text with
    fewer words than a shingle counts as one shingle.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= shingle:
        return np.array([hashed(joined, seed)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:len(words) - shingle + 1].tolist()
    return np.array([hashed(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:].tolist())], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANES
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int(_WEIGHTS[counts.ravel() * 2 > len(hashes)].sum())


def sketch(hashes: np.ndarray) -> bytes:
    """A second fingerprint of 256 bits, independent of the first."""
    return np.array([majority((hashes ^ (hashes >> np.uint64(29))) * c) for c in _MIXERS], np.uint64).tobytes()


def fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 4) -> DataFrame:
    """(doc_id, fp) per row; ``fp`` holds the 64 bits as a signed long. Null texts have no words."""
    picked = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].alias("text"))

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [majority(shingle_hashes(t, shingle)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "fp": np.array(prints, np.uint64).view(np.int64)})

    return picked.mapInArrow(run, "doc_id long, fp long")


def shingle_set(text: str | None, shingle: int) -> tuple[np.ndarray, int]:
    """The different shingle hashes in order, and a digest of them as a signed number."""
    import xxhash

    hashes = np.unique(shingle_hashes(text, shingle))
    return hashes, xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def set_prints(docs: DataFrame, text: str, id_column: str, shingle: int) -> DataFrame:
    """(doc_id, node, fp, sketch, size) per row, of the set of its shingles; ``node`` is the set's digest."""
    picked = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].alias("text"))

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "node": pa.array([node for _, node in made], pa.int64()),
                "fp": np.array([majority(h) for h, _ in made], np.uint64).view(np.int64),
                "sketch": pa.array([sketch(h) for h, _ in made], pa.binary()),
                "size": pa.array([len(h) for h, _ in made], pa.int64())})

    return picked.mapInArrow(run, "doc_id long, node long, fp long, sketch binary, size long")


def forest(left: np.ndarray, right: np.ndarray | None, radius: int,
           most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what links connect; right None: links within left.

    Rows hold the fingerprint, its sketch if ``most`` is given, and last the node, which
    may be the fingerprint itself. A link has at most ``radius`` different bits of the
    fingerprint and, if given, at most ``most`` of the sketch.
    """
    rows = left if right is None else np.concatenate([left, right])
    left, right, extra, nodes = left[:, 0], None if right is None else right[:, 0], rows[:, 1:-1], rows[:, -1]
    label = np.arange(len(nodes))
    shift = 0 if right is None else len(left)
    columns = left if right is None else right
    step = max(1, STRIP // max(1, len(columns)))
    for at in range(0, len(left), step):
        near = np.bitwise_count(left[at:at + step, None] ^ columns[None, :]) <= radius
        if right is None:
            near &= np.arange(len(columns))[None, :] > np.arange(at, at + len(near))[:, None]
        if not near.any():
            continue
        i, j = np.nonzero(near)
        i, j = i + at, j + shift
        if most is not None:
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            alike = np.bitwise_count(extra[i] ^ extra[j]).sum(axis=1) <= most
            i, j = i[alike], j[alike]
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(label, up := label[label]):
                label = up
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _tile_blocks(counts: dict[tuple[int, int], int], block: int) -> dict[tuple[int, int], int]:
    return {tile: -(-n // block) for tile, n in counts.items()}


def _bin(radius: int) -> int:
    """Population counts that share a tile: wider for a wide radius, where narrow tiles would all meet each other."""
    return max(1, radius // 2 - 1)


def _others(tile: tuple[int, int], blocks: dict[tuple[int, int], int], radius: int | None):
    """Tiles whose population counts differ by at most the radius in sum from some of this one's.

    Without a radius tiles are bins of size, and links reach the next bin.
    """
    if radius is None:
        size = tile[0] * 33 + tile[1]
        yield from (t for t in (divmod(x, 33) for x in range(size - 1, size + 2)) if t in blocks)
        return
    width = _bin(radius)
    reach = radius // width + 1
    apart = lambda d: (abs(d) - 1) * width + 1 if d else 0
    for da in range(-reach, reach + 1):
        for db in range(-reach, reach + 1):
            if apart(da) + apart(db) <= radius and (tile[0] + da, tile[1] + db) in blocks:
                yield tile[0] + da, tile[1] + db


def _partners(tile: tuple[int, int], salt: int, blocks: dict[tuple[int, int], int], radius: int | None):
    """Pairs of blocks, this one and any other that may hold links with it, the earlier first."""
    for other in _others(tile, blocks, radius):
        for k in range(blocks[other]):
            yield min((tile, salt), (other, k)), max((tile, salt), (other, k))


def _block_id(tile: tuple[int, int], salt: int) -> int:
    return (salt * 33 + tile[0]) * 33 + tile[1]


def link_forest(prints: DataFrame, radius: int = 4, most: int | None = None, block: int = BLOCK,
                similarity: float | None = None) -> DataFrame:
    """Edges (a, b) between different nodes, connecting exactly what links connect (see :func:`forest`).

    ``prints`` has one row (fp) per different ``fp``, which is the node. With ``most`` it has a row
    (node, fp, sketch, size) per node, and sets are only compared if their sizes allow the
    similarity. The driver sees the sizes of the tiles, at most 33 x 33 numbers.
    """
    if most is None:
        width, reach = F.lit(_bin(radius)), radius
        tile = [F.floor(F.bit_count(half) / width).cast("int").alias(name) for name, half in (
            ("ta", F.shiftrightunsigned("fp", 32)), ("tb", F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))))]
        tiled = prints.select("fp", F.lit(b"").alias("sketch"), F.col("fp").alias("node"), *tile)
    else:
        reach = None
        size = F.floor(F.log(F.greatest("size", F.lit(1))) / (-math.log(similarity) + 1e-6)).cast("int")
        tiled = prints.where("size > 0").select("fp", "sketch", "node", F.floor(size / 33).cast("int").alias("ta"),
                                                (size % 33).alias("tb"))
    sizes = {(r.ta, r.tb): r["count"] for r in tiled.groupBy("ta", "tb").count().collect()}
    blocks = _tile_blocks(sizes, block)
    salts = F.create_map(*[F.lit(x) for (a, b), k in blocks.items() if k > 1 for x in (a * 33 + b, k)]) \
        if any(k > 1 for k in blocks.values()) else None
    salt = F.lit(0) if salts is None else F.coalesce(
        F.pmod(F.xxhash64("node"), salts[F.col("ta") * 33 + F.col("tb")]), F.lit(0))
    salted = tiled.withColumn("salt", salt.cast("int"))

    @handing_back
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(key, parts):
            payload, width = np.concatenate(parts).tobytes(), parts[0].shape[1]
            mine = _block_id(key[:2], key[2])
            pairs = [(_block_id(*low), _block_id(*high)) for low, high in _partners(key[:2], key[2], blocks, reach)]
            step = max(1, BATCH_BYTES // len(payload))
            for at in range(0, len(pairs), step):
                some = pairs[at:at + step]
                yield pa.RecordBatch.from_pydict({
                    "low": pa.array([p[0] for p in some], pa.int64()),
                    "high": pa.array([p[1] for p in some], pa.int64()),
                    "own": pa.array([mine] * len(some), pa.int64()), "width": pa.array([width] * len(some), pa.int32()),
                    "fps": pa.array([payload] * len(some), pa.binary())})

        key, parts = None, []
        for batch in batches:
            ta, tb, salt_of, fps, nodes = (batch.column(c).to_numpy(zero_copy_only=False)
                                           for c in ("ta", "tb", "salt", "fp", "node"))
            cuts = np.flatnonzero((np.diff(ta) != 0) | (np.diff(tb) != 0) | (np.diff(salt_of) != 0)) + 1
            records = fps.view(np.uint64)[:, None]
            if most is not None:
                more = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(len(fps), -1)
                records = np.column_stack([records, more, nodes.view(np.uint64)])
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)]):
                if a == b:
                    continue
                now = (int(ta[a]), int(tb[a]), int(salt_of[a]))
                if key is not None and now != key:
                    yield from rows(key, parts)
                    parts = []
                key = now
                parts.append(records[a:b])
        if key is not None:
            yield from rows(key, parts)

    @handing_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, None
        for batch in batches:
            lows, highs, widths = (batch.column(c).to_pylist() for c in ("low", "high", "width"))
            payloads = batch.column("fps")
            for i, (low, high, width) in enumerate(zip(lows, highs, widths)):
                fps = np.frombuffer(payloads[i].as_py(), np.uint64).reshape(-1, width)
                if low == high:
                    a, b = forest(fps, None, radius, most)
                elif pair == (low, high):
                    a, b = forest(held, fps, radius, most)
                    pair, held = None, None
                else:
                    pair, held = (low, high), fps
                    continue
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

    packed = (salted.repartition("ta", "tb", "salt").sortWithinPartitions("ta", "tb", "salt")
              .mapInArrow(pack, "low long, high long, own long, width int, fps binary"))
    return (packed.repartition("low", "high").sortWithinPartitions("low", "high", "own")
            .mapInArrow(compare, "a long, b long"))


def _classes(distinct: DataFrame, links: DataFrame, node: str) -> DataFrame:
    """(node, root, component_id) per row of ``distinct`` (node, first_id)."""
    roots = connected_components(links, "a", "b")
    rooted = distinct.join(roots.withColumnRenamed("node", node), node, "left").select(
        node, "first_id", F.coalesce("root", node).alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(named, "root").select(node, "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """Per row of ``docs``: doc_id, fp (signed long) and component_id, the smallest doc_id reachable by links.

    Rows without words all have fingerprint zero and are linked. Rows that repeat an
    id stay; a null id takes part in links but never names a component unless all
    ids of the component are null.
    """
    prints = store(fingerprints(docs, text, id_column, shingle), "fingerprints")
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    return prints.join(_classes(distinct, link_forest(distinct, radius), "fp"), "fp").select("doc_id", "fp", "component_id")


def similar_forest(nodes: np.ndarray, prints: np.ndarray, sets: list[np.ndarray], split: int | None,
                   similarity: float, radius: int, most: int) -> list[tuple[int, int]]:
    """Edges that connect what pairs of sets of at least that similarity connect, among pairs within the bounds.

    ``prints`` holds fingerprint and sketch. With ``split`` only pairs across that position count.
    """
    sizes, label, edges = np.array([len(x) for x in sets]), np.arange(len(sets)), []
    for i in range(len(sets) if split is None else split):
        others = np.arange(i + 1 if split is None else split, len(sets))
        low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[(label[others] != label[i]) & (low + 1e-9 >= similarity * high)]
        others = others[np.bitwise_count(prints[others, 0] ^ prints[i, 0]) <= radius]
        others = others[np.bitwise_count(prints[others, 1:] ^ prints[i, 1:]).sum(axis=1) <= most]
        if not len(others):
            continue
        joined = np.concatenate([sets[j] for j in others.tolist()])
        place = np.minimum(np.searchsorted(sets[i], joined), sizes[i] - 1)
        starts = np.cumsum(sizes[others]) - sizes[others]
        common = np.add.reduceat((sets[i][place] == joined).astype(np.int64), starts)
        alike = others[common + 1e-9 >= similarity * (sizes[others] + sizes[i] - common)]
        joining, first = np.unique(label[alike], return_index=True)
        edges += [(int(nodes[i]), int(nodes[j])) for j in alike[first].tolist()]
        label[np.isin(label, joining)] = label[i]
    return edges


def verified_links(docs: DataFrame, distinct: DataFrame, candidates: DataFrame, text: str, id_column: str, shingle: int,
                   similarity: float, radius: int, most: int, block: int = BLOCK_SHINGLES) -> DataFrame:
    """Edges (a, b) of :func:`similar_forest` in each component of ``candidates`` (node, root).

    A component of more than ``block`` shingles is cut into parts by a hash, and every
    pair of parts is one unit of work. Only texts of candidates travel.
    """
    members = store(distinct.join(candidates, "node"), "candidates")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("size") / block).alias("parts")).where("parts > 1")
    large = store(sizes, "large-components")
    if large.limit(HOT_SHARDS + 1).count() <= HOT_SHARDS:
        large = F.broadcast(large)
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    units = members.join(large, "root", "left").withColumn("own", F.pmod(F.xxhash64("node"), parts)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).select(
        "node", "fp", "sketch", "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own")
    shared = docs.sparkSession.sparkContext.broadcast(_bit_filter(members.select(
        F.col("node").bitwiseXOR(F.coalesce("first_id", F.lit(0).cast("long"))).alias("anchor"))))
    picked = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].alias("text"))

    @handing_back
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            ids = np.array([x or 0 for x in batch.column("doc_id").to_pylist()], np.int64)
            nodes = np.array([shingle_set(t, shingle)[1] for t in batch.column("text").to_pylist()], np.int64)
            place = (nodes ^ ids) & (FILTER_BITS - 1)
            on = np.flatnonzero((bits[place >> 3] >> (7 - (place & 7))) & 1)
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes[on]), "text": batch.column("text").take(pa.array(on))})

    @handing_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(key, group):
            nodes, prints = np.array([x[1] for x in group]), np.array([x[2] for x in group])
            split = None if key[1] == key[2] else sum(x[0] == key[1] for x in group)
            found = similar_forest(nodes, prints, [x[3] for x in group], split, similarity, radius, most)
            return pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in found], pa.int64()),
                                               "b": pa.array([x[1] for x in found], pa.int64())})

        key, group = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("root", "low", "high", "own", "node", "fp", "sketch")]
            for i, (root, low, high, own, node, fp, more) in enumerate(zip(*columns)):
                if (root, low, high) != key:
                    if group:
                        yield edges(key, group)
                    key, group = (root, low, high), []
                if not group or group[-1][1] != node:  # rows that repeat an id bring a text again
                    prints = np.concatenate([np.array([fp]).view(np.uint64), np.frombuffer(more, np.uint64)])
                    group.append((own, node, prints, shingle_set(batch.column("text")[i].as_py(), shingle)[0]))
        if group:
            yield edges(key, group)

    dealt = units.join(picked.mapInArrow(texts, "node long, text string"), "node")
    order = ("root", "low", "high")
    return dealt.repartition(*order).sortWithinPartitions(*order, "own", "node").mapInArrow(compare, "a long, b long")


def deduplicate(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 5,
                similarity: float = 0.8, radius: int = 24, most: int = 76) -> DataFrame:
    """The rows of ``docs``, one of each class of near copies: the one with the smallest id.

    A link is a similarity (Jaccard) of at least ``similarity`` between two texts' sets of
    five-word shingles, found on the sets themselves; classes are the components. Pairs
    are tried within ``radius`` bits of the fingerprint and ``most`` of the 256 bits of the
    sketch. At 0.8 they differ in 10 and 39 bits on average, with deviations of 2.9 and
    5.9, so hardly one in ten thousand is missed; the likeliest to be are sets of four
    and five shingles, with 12 and 48 bits.
    Rows that repeat an id within a class are copies: one stays. A class without an id
    keeps one row.
    """
    prints = store(set_prints(docs, text, id_column, shingle), "fingerprints")
    distinct = store(prints.groupBy("node", "fp", "sketch", "size").agg(F.min("doc_id").alias("first_id")), "distinct")
    candidates = connected_components(link_forest(distinct, radius, most, similarity=similarity), "a", "b")
    links = verified_links(docs, distinct, candidates, text, id_column, shingle, similarity, radius, most)
    names = docs.columns
    node, root, first_id = ("_" * max(map(len, names)) + n for n in ("node", "root", "first"))  # longer than any name there is
    classes = _classes(distinct, links, "node").withColumnsRenamed({"node": node, "root": root, "component_id": first_id})

    @handing_back
    def with_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, shingle)[1] for t in batch.column(text).to_pylist()]
            yield batch.append_column(node, pa.array(found, pa.int64()))

    marked = docs.mapInArrow(with_node, StructType([*docs.schema.fields, StructField(node, LongType())]))
    first = marked.join(classes, node).where(F.col(id_column).cast("long").eqNullSafe(F.col(first_id)))
    return first.dropDuplicates([root]).select(*names)
