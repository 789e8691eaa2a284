"""Removing word spans that an earlier document holds, by suffix automata of reference shards.

A window is ``span`` consecutive words. A word goes when a window covers it whose
words also start somewhere in a document of smaller id.

1. **Anchors.** Each window names the smallest hash among its word grams. Equal
   windows name equal anchors, and neighbouring windows mostly share one, so a text
   has few. Anchors named by two documents are set in a bit filter of fixed size.
2. **Segments.** A run of windows with the same anchor is a segment. Segments of
   anchors in the filter are written out with their text; a bit set by chance only
   costs a segment that matches nothing.
3. **Shards.** Equal segments collapse to one with its smallest id. All segments of
   an anchor form a reference shard, for which a task builds a suffix automaton over
   words; every state knows the smallest id among its occurrences. The segments
   stream through it, and the matching statistics tell for each window the smallest
   id that holds it. A document's windows can only match in the shards of its own
   anchors, so shards go where the segments go instead of all shards to all tasks.
   A shard with many segments is cut into parts, and every part of the segments
   meets every part of the references.
4. **Removal.** Windows whose smallest id is below the document's own cover the words
   to remove. They meet the text again by id and digest.

Windows are judged on the input. Null texts have no words. Rows without an id are
neither references nor shortened. Rows that repeat an id are one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.sources.storage import store

SPAN, GRAM = 50, 8
FILTER_BITS, CHUNK_BITS = 1 << 25, 1 << 16
SHARD_SEGMENTS, HOT_SHARDS = 2000, 100_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones((2, 1), np.uint64)


def _power_tables(n: int) -> np.ndarray:
    """Powers of the base and of its inverse, grown to the longest text seen by this worker."""
    global _powers
    if _powers.shape[1] < n:
        size = 1 << (n - 1).bit_length()
        rows = np.full((2, size), [[_BASE], [_INVERSE]], np.uint64)
        rows[:, 0] = 1
        _powers = np.cumprod(rows, axis=1, dtype=np.uint64)
    return _powers


def normal(text: str | None) -> bytes:
    """The words joined by single blanks."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def window_anchors(joined: bytes, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of every window, and where each word starts and ends."""
    data = np.frombuffer(joined, np.uint8)
    blanks = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], blanks + 1]) if len(data) else np.zeros(0, np.int64)
    ends = np.append(blanks, len(data)) if len(data) else np.zeros(0, np.int64)
    if len(starts) < span:
        return np.zeros(0, np.uint64), starts, ends
    powers = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * powers[0, :len(data)], out=prefix[1:])
    first, last = starts[:len(starts) - gram + 1], ends[gram - 1:]
    h = (prefix[last] - prefix[first]) * powers[1, first]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    width, low = span - gram + 1, h
    reach = 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if width > reach:
        low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
    return low, starts, ends


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return cuts, np.diff(np.append(cuts, len(values)))


class Automaton:
    """Suffix automaton of several word sequences; each state knows the smallest id it occurs in."""

    def __init__(self, references: list[tuple[int, list]]):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]
        for doc, words in references:
            last = 0
            for w in words:
                last = self._extend(last, w)
                if self.least[last] is None or doc < self.least[last]:
                    self.least[last] = doc
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.least[state] is not None and (self.least[up] is None or self.least[state] < self.least[up]):
                self.least[up] = self.least[state]

    def _add(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.least.append(None)
        return len(self.link) - 1

    def _split(self, state: int, target: int, word) -> int:
        """The state of the words up to ``state`` and then ``word``, apart from longer ones of ``target``."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._add(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        fresh = self._add(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = fresh
            state = self.link[state]
        if state >= 0:
            self.link[fresh] = self._split(state, self.next[state][word], word)
        return fresh

    def windows(self, words: list, span: int) -> list:
        """For every window of ``span`` words the smallest id that holds it, or None."""
        following, link, length, least = self.next, self.link, self.length, self.least
        state, matched, found = 0, 0, []
        for at, w in enumerate(words, 1):
            while state and w not in following[state]:
                state = link[state]
                matched = length[state]
            if w in following[state]:
                state = following[state][w]
                matched += 1
            if matched >= span:
                while length[link[state]] >= span:
                    state = link[state]
                    matched = min(matched, length[state])
            if at >= span:
                found.append(least[state] if matched >= span else None)
        return found


# ---------------------------------------------------------------- over tables

def _anchors(rows: DataFrame, span: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owners = [np.zeros(0, np.uint64)], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                anchors = window_anchors(normal(text), span, gram)[0]
                if len(anchors):
                    anchors = np.unique(anchors[_runs(anchors)[0]])
                    found.append(anchors)
                    owners.append(np.full(len(anchors), doc, np.int64))
            yield pa.RecordBatch.from_pydict({"anchor": np.concatenate(found).view(np.int64),
                                              "doc_id": np.concatenate([np.zeros(0, np.int64), *owners])})

    return rows.mapInArrow(run, "anchor long, doc_id long")


def _bit_filter(anchors: DataFrame) -> np.ndarray:
    """Bits of the anchors, ``FILTER_BITS`` in all, whatever their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            bits = batch.column("bit").to_numpy()
            for chunk in np.unique(bits // CHUNK_BITS).tolist():
                own = bits[bits // CHUNK_BITS == chunk] % CHUNK_BITS
                chunks.setdefault(chunk, np.zeros(CHUNK_BITS, bool))[own] = True
        for chunk, flags in chunks.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()),
                                              "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    bits = anchors.select(F.col("anchor").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit"))
    dealt = bits.withColumn("chunk", F.floor(F.col("bit") / CHUNK_BITS)).repartition("chunk").select("bit")
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in dealt.mapInArrow(run, "chunk long, bits binary").collect():
        table[r.chunk * CHUNK_BITS // 8:(r.chunk + 1) * CHUNK_BITS // 8] |= np.frombuffer(r.bits, np.uint8)
    return table


_SEGMENT = "anchor long, h1 long, h2 long, doc_id long, digest long, start int, windows int, words binary"


def _segments(rows: DataFrame, table: np.ndarray, span: int, gram: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        bits = shared.value
        for batch in batches:
            made: dict[str, list] = {k: [] for k in ("anchor", "h1", "h2", "doc_id", "digest", "start", "windows", "words")}
            for doc, digest, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "text"))):
                joined = normal(text)
                anchors, starts, ends = window_anchors(joined, span, gram)
                if not len(anchors):
                    continue
                first, count = _runs(anchors)
                named = anchors[first]
                place = (named & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                on = (bits[place >> 3] >> (7 - (place & 7))) & 1
                for k in np.flatnonzero(on).tolist():
                    s, n = int(first[k]), int(count[k])
                    words = joined[starts[s]:ends[s + n + span - 2]]
                    h = xxhash.xxh3_128_intdigest(words)
                    for name, value in (("anchor", int(named[k].view(np.int64))), ("h1", (h >> 64) - (1 << 63)),
                                        ("h2", (h & ((1 << 64) - 1)) - (1 << 63)), ("doc_id", doc), ("digest", digest),
                                        ("start", s), ("windows", n), ("words", words)):
                        made[name].append(value)
                if len(made["words"]) >= 5000:
                    yield _segment_batch(made)
                    made = {k: [] for k in made}
            yield _segment_batch(made)

    return rows.mapInArrow(run, _SEGMENT)


def _segment_batch(made: dict[str, list]) -> pa.RecordBatch:
    kinds = {"start": pa.int32(), "windows": pa.int32(), "words": pa.binary()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in made.items()})


def _matched(distinct: DataFrame, span: int, shard_segments: int) -> DataFrame:
    """(h1, h2, runs): for each different segment, runs of windows (offset, n, first id) that an earlier id holds."""
    sizes = distinct.groupBy("anchor").count().where(F.col("count") > shard_segments)
    hot = store(sizes.select("anchor", F.ceil(F.col("count") / shard_segments).alias("parts")), "hot-shards")
    if hot.limit(HOT_SHARDS + 1).count() <= HOT_SHARDS:
        hot = F.broadcast(hot)
    part = F.pmod(F.col("h1"), F.col("parts"))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    one = F.array(F.lit(0).cast("long"))
    roles = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(2).alias("role"), one.alias("r"), one.alias("q")))).otherwise(
        F.array(F.struct(F.lit(0).alias("role"), F.array(part).alias("r"), every.alias("q")),
                F.struct(F.lit(1).alias("role"), every.alias("r"), F.array(part).alias("q"))))
    dealt = distinct.join(hot, "anchor", "left").withColumn("as", F.explode(roles)).withColumn(
        "r", F.explode("as.r")).withColumn("q", F.explode("as.q")).select(
        "anchor", "r", "q", F.col("as.role").alias("role"), "h1", "h2", "least", "most", "windows", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group):
            references = [x for x in group if x[0] != 1]
            queries = [x for x in group if x[0] != 0]
            if len(references) == 1 and len(queries) == 1 and references[0][1:3] == queries[0][1:3]:  # one segment: the automaton would only find itself
                for _, h1, h2, least, most, windows, _ in queries:
                    if least < most:
                        yield h1, h2, [{"offset": 0, "n": windows, "first": least}]
                return
            machine = Automaton([(x[3], x[6].split(b" ")) for x in references])
            for _, h1, h2, least, most, windows, words in queries:
                firsts = machine.windows(words.split(b" "), span)
                runs, at = [], 0
                while at < len(firsts):
                    stop = at
                    while stop < len(firsts) and firsts[stop] == firsts[at]:
                        stop += 1
                    if firsts[at] is not None and firsts[at] < most:
                        runs.append({"offset": at, "n": stop - at, "first": firsts[at]})
                    at = stop
                if runs:
                    yield h1, h2, runs

        def batch_of(rows):
            return pa.RecordBatch.from_pydict({
                "h1": pa.array([r[0] for r in rows], pa.int64()), "h2": pa.array([r[1] for r in rows], pa.int64()),
                "runs": pa.array([r[2] for r in rows], pa.list_(pa.struct(
                    [("offset", pa.int32()), ("n", pa.int32()), ("first", pa.int64())])))})

        key, group, out = None, [], []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("anchor", "r", "q")))
            values = zip(*(batch.column(c).to_pylist() for c in ("role", "h1", "h2", "least", "most", "windows", "words")))
            for now, value in zip(keys, values):
                if now != key:
                    out.extend(found(group) if group else ())
                    key, group = now, []
                    if len(out) >= 5000:
                        yield batch_of(out)
                        out = []
                group.append(value)
        out.extend(found(group) if group else ())
        yield batch_of(out)

    return dealt.repartition("anchor", "r", "q").sortWithinPartitions("anchor", "r", "q").mapInArrow(
        run, "h1 long, h2 long, runs array<struct<offset:int,n:int,first:long>>")


def repeated_windows(rows: DataFrame, span: int = SPAN, gram: int = GRAM,
                     shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(doc_id, digest, spans): per document the runs (start, n) of windows that an earlier document holds.

    ``rows`` has doc_id, digest and text.
    """
    rows = rows.where("doc_id is not null")
    anchors = store(_anchors(rows, span, gram), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    segments = store(_segments(rows, _bit_filter(shared.select("anchor")), span, gram), "segments")
    distinct = segments.groupBy("anchor", "h1", "h2").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.first("windows").alias("windows"),
        F.first("words").alias("words"))
    matched = _matched(distinct, span, shard_segments)
    hits = segments.select("h1", "h2", "doc_id", "digest", "start").join(matched, ["h1", "h2"]).select(
        "doc_id", "digest", "start", F.explode(F.filter("runs", lambda r: r["first"] < F.col("doc_id"))).alias("run"))
    return hits.select("doc_id", "digest", F.struct((F.col("start") + F.col("run.offset")).alias("start"),
                                                    F.col("run.n").alias("n")).alias("span")).groupBy(
        "doc_id", "digest").agg(F.collect_set("span").alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", span: int = SPAN, gram: int = GRAM,
                   shard_segments: int = SHARD_SEGMENTS, with_text: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, if wanted, ``kept``, the words that stay."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("digest"),
                       docs[text].alias("text"))
    found = store(repeated_windows(rows, span, min(gram, span), shard_segments), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept")}
            for t, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                joined = normal(t)
                words, removed = joined.count(b" ") + (len(joined) > 0), 0
                if spans:
                    change = np.zeros(words + 1, np.int32)
                    for s in spans:
                        change[s["start"]] += 1
                        change[s["start"] + s["n"] + span - 1] -= 1
                    stays = np.cumsum(change)[:-1] == 0
                    removed = int((~stays).sum())
                    joined = b" ".join(w for w, on in zip(joined.split(b" "), stays.tolist()) if on)
                out["n_words"].append(words)
                out["n_removed"].append(removed)
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                out["kept"].append(joined.decode("utf-8", "surrogatepass") if with_text else None)
            made = {"doc_id": batch.column("doc_id"), "n_words": pa.array(out["n_words"], pa.int64()),
                    "n_removed": pa.array(out["n_removed"], pa.int64()),
                    "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
            if with_text:
                made["kept"] = pa.array(out["kept"], pa.string())
            yield pa.RecordBatch.from_pydict(made)

    return rows.join(found, ["doc_id", "digest"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
