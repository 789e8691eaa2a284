"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

Units are UTF-16 code units with white space folded to a blank; a document is
padded before its first and after its last unit. There is one model per language,
of order 4, trained on all trusted documents of that language. A gram of up to four
units fits a 64-bit key, from which its context and its suffix follow by shifts.

* **Counts** come out of the tasks once per gram and page of text, and are summed by
  key. Lower orders count the different units before a gram. Discounts follow from
  the counts of counts of each language and order.
* **Scoring** is a join by shards of the keys. Documents are laid out in pages of one
  language. A page asks once for each different gram it holds; the requests go to
  the shards of the model, packed, and the answers go back to the page, which meets
  its compressed text there. The traffic grows with the number of pages and their
  different grams, not with the number of units.
* **Thresholds** are quantiles of the perplexities of the trusted documents of each
  language, at both ends: text of rare grams has a high, monotonous text a low one.

Trusted documents are found by an exact semi-join with the labels. A bit filter of
fixed size over the trusted ids (1 MB, whatever the input) goes ahead of it and keeps
most other texts out of the shuffle.

A page's content depends only on the order of its input rows, so the input should be
a scan of stored files, whose tasks repeat identically when one is lost; a page whose
answers do not fit fails instead of scoring wrongly.

Null texts count as empty. Documents of a language without trusted text, or of none,
have no perplexity and are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwell.llm.batches import hand_back, handing_back
from tripwell.sources.storage import store

ORDER = 4
PAGE_CHARS = 4_000_000
SHARD_GRAMS = 250_000
FILTER_BITS = 1 << 23
BROADCAST_LANGUAGES = 10_000
QUANTILES = (0.001, 0.995)
_PAD = "￿"
_BLANKS = dict.fromkeys(range(33), " ")


# ---------------------------------------------------------------- grams of a page

def _ranked(values: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """The different values below ``cells``, sorted, each value's place among them, and how to find others' places.

    A table of all cells is quick while there are few; beyond that the values are sorted,
    so memory goes with their number, whatever the alphabet.
    """
    if cells <= 4 * len(values) + (1 << 16):
        flag = np.zeros(cells, bool)
        flag[values] = True
        unique = np.flatnonzero(flag)
        now = np.full(cells, -1, np.int32)
        now[unique] = np.arange(len(unique), dtype=np.int32)
        return unique, now[values], now.__getitem__
    order = np.argsort(values, kind="stable").astype(np.int32)
    ordered = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    unique = ordered[new]
    at = np.empty(len(values), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return unique, at, lambda wanted: np.searchsorted(unique, wanted.astype(unique.dtype)).astype(np.int32)


class Grams:
    """The different grams of a page up to the order, and which gram ends at each unit."""

    def __init__(self, texts: list[str | None]):
        lead = _PAD * (ORDER - 1)
        pieces = [f"{lead}{(t or '').translate(_BLANKS)}{_PAD}".encode("utf-16-le", "surrogatepass") for t in texts]
        self.sizes = np.array([len(p) // 2 for p in pieces])
        units = np.frombuffer(b"".join(pieces), np.uint16)
        first = np.cumsum(self.sizes) - self.sizes
        scored = np.ones(len(units), bool)
        for k in range(ORDER - 1):
            scored[first + k] = False
        self.scored = scored
        before = np.append(scored[1:], False)  # ends of contexts
        wanted = scored | before
        seen = np.zeros(1 << 16, bool)
        seen[units] = True
        letters = np.flatnonzero(seen)
        number = np.zeros(1 << 16, np.int32)
        number[letters] = np.arange(len(letters), dtype=np.int32)
        letter = number[units]
        size = len(letters)
        empty = np.zeros(1, np.int32)
        self.keys, self.context, self.suffix, self.wanted = [np.zeros(1, np.uint64)], [empty], [empty], [np.ones(1, bool)]
        at, place = np.zeros(len(units), np.int32), None
        for level in range(1, ORDER + 1):
            cells = len(self.keys[-1]) * size
            # narrow while they fit, which they do unless a page holds very many different grams
            pair = np.empty(len(units), np.int32 if cells < 1 << 31 else np.int64)
            pair[0] = letter[0]
            np.multiply(at[:-1], size, out=pair[1:], dtype=pair.dtype)
            pair[1:] += letter[1:]
            at = None
            unique, at, found = _ranked(pair, cells)
            pair = None
            context, last = (x.astype(np.int32) for x in np.divmod(unique, size))
            unique = None
            if level == 1:
                self.suffix.append(np.zeros(len(context), np.int32))
            else:
                self.suffix.append(place(self.suffix[-1][context].astype(np.int64) * size + last))
            self.context.append(context)
            self.keys.append((self.keys[-1][context] << np.uint64(16)) | letters[last].astype(np.uint64))
            place = found
            use = np.zeros(len(context), bool)
            use[at[wanted if level < ORDER else scored]] = True
            self.wanted.append(use)
        self.at = at

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the highest-order grams and how often each ends at a scored unit."""
        n = np.bincount(self.at[self.scored], minlength=len(self.keys[-1]))
        some = n > 0
        return self.keys[-1][some], n[some]

    def requests(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Level, key and shard of every gram asked for, ordered by shard."""
        levels = np.concatenate([np.full(int(w.sum()), k, np.uint8) for k, w in enumerate(self.wanted)])
        keys = np.concatenate([k[w] for k, w in zip(self.keys, self.wanted)])
        shard = shard_of(levels, keys, shards)
        order = np.argsort(shard, kind="stable")
        return levels[order], keys[order], shard[order]

    def perplexities(self, shards: int, answers: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Per document, from the answers (shard, a, g) to :meth:`requests`."""
        levels = np.concatenate([np.full(int(w.sum()), k, np.uint8) for k, w in enumerate(self.wanted)])
        keys = np.concatenate([k[w] for k, w in zip(self.keys, self.wanted)])
        order = np.argsort(shard_of(levels, keys, shards), kind="stable")
        answers = sorted(answers, key=lambda x: x[0])
        a, g = (np.concatenate([x[i] for x in answers]) if answers else np.zeros(0) for i in (1, 2))
        if len(a) != len(order):
            raise ValueError("the answers belong to another page: the input is not read in a fixed order")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        a, g = a[back].astype(np.float64), g[back].astype(np.float64)
        end, tables = 0, []
        for w in self.wanted:
            start, end = end, end + int(w.sum())
            full_a, full_g = np.zeros(len(w)), np.ones(len(w))
            full_a[w], full_g[w] = a[start:end], g[start:end]
            tables.append((full_a, full_g))
        p = tables[0][0]
        for level in range(1, ORDER + 1):
            p = tables[level][0] + tables[level - 1][1][self.context[level]] * p[self.suffix[level]]
        with np.errstate(divide="ignore"):
            logs = np.log(p).astype(np.float32)[self.at]
        logs[~self.scored] = 0
        starts = np.cumsum(self.sizes) - self.sizes
        return np.exp(-np.add.reduceat(logs, starts, dtype=np.float64) / (self.sizes - ORDER + 1)) if len(starts) else np.zeros(0)


def shard_of(levels: np.ndarray, keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = (keys + levels.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def _numbered(docs: DataFrame) -> DataFrame:
    """With the number of the partition, which stays the same when the rows pass through a union."""
    return docs.select("doc_id", "lang", "text", F.spark_partition_id().alias("part"))


def _pages(batches: Iterator[pa.RecordBatch], limit: int):
    """(page id, language, ids, texts) of one task; a page is flushed when it is full or the task ends.

    Texts come as such or, under the name ``packed``, compressed.
    """
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    task, made = None, 0
    open_: dict[str, tuple[list, list]] = {}
    sizes: dict[str, int] = {}
    total = 0
    for batch in batches:
        if task is None and batch.num_rows:
            task = batch.column("part")[0].as_py()
        packed = "packed" in batch.schema.names
        for doc, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "packed" if packed else "text"))):
            if packed:
                text = unpack(text).decode("utf-8", "surrogatepass")
            ids, texts = open_.setdefault(lang, ([], []))
            ids.append(doc)
            texts.append(text)
            size = len(text or "") + ORDER
            sizes[lang] = sizes.get(lang, 0) + size
            total += size
            if total >= limit:
                lang = max(sizes, key=sizes.get)
                ids, texts = open_.pop(lang)
                total -= sizes.pop(lang)
                yield (task << 32) + made, lang, ids, texts
                made += 1
    for lang, (ids, texts) in open_.items():
        yield (task << 32) + made, lang, ids, texts
        made += 1


# ---------------------------------------------------------------- training

def _gram_counts(docs: DataFrame, limit: int) -> DataFrame:
    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lang, _, texts in _pages(batches, limit):
            keys, counts = Grams(texts).counts()
            for at in range(0, len(keys), 100_000):
                part = keys[at:at + 100_000]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(part), pa.string()), "key": part.view(np.int64),
                    "n": counts[at:at + 100_000].astype(np.int64)})

    numbered = docs.withColumn("part", F.spark_partition_id())
    return numbered.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discount(n: Column) -> Column:
    return F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))


def train(trusted: DataFrame, limit: int = PAGE_CHARS) -> DataFrame:
    """The model as (lang, level, key, a, g).

    ``a`` is the discounted share of a gram among those of its context, ``g`` the mass
    that the gram, as a context, leaves to its suffix. Level 0 holds the uniform
    probability of a unit and the mass left to it.
    """
    grams = _gram_counts(trusted, limit).select("lang", F.lit(ORDER).alias("level"), "key", "n")
    grams = store(grams, "grams")
    levels, upper = [grams], grams
    for level in range(ORDER - 1, 0, -1):
        upper = store(upper.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 16 * level) - 1)).alias("key")).agg(
            F.count("*").alias("n")).select("lang", F.lit(level).alias("level"), "key", "n"), "grams")
        levels.append(upper)
    counted = levels[0]
    for more in levels[1:]:
        counted = counted.union(more)
    of_counts = counted.groupBy("lang", "level").agg(
        *[F.count(F.when(F.col("n") == i, 1)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    discounts = of_counts.select("lang", "level", *[
        F.when(usable, F.least(F.greatest(i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"), F.lit(0.0)), F.lit(float(i))))
        .otherwise(F.lit(i / 2)).alias(f"d{i}") for i in (1, 2, 3)])
    discounted = counted.join(discounts, ["lang", "level"]).withColumns({
        "context": F.shiftrightunsigned("key", 16), "taken": _discount(F.col("n"))})
    contexts = discounted.groupBy("lang", "level", "context").agg(
        F.sum("n").alias("total"), F.sum("taken").alias("left_over"))
    shares = discounted.join(contexts, ["lang", "level", "context"]).select(
        "lang", "level", "key", ((F.col("n") - F.col("taken")) / F.col("total")).alias("a"))
    masses = contexts.select("lang", (F.col("level") - 1).alias("level"), F.col("context").alias("key"),
                             (F.col("left_over") / F.col("total")).alias("g"))
    uniform = counted.where("level = 1").groupBy("lang").agg((1 / (F.count("*") + 1)).alias("a")).select(
        "lang", F.lit(0).alias("level"), F.lit(0).cast("long").alias("key"), "a")
    return shares.union(uniform).join(masses, ["lang", "level", "key"], "full").select(
        "lang", "level", "key", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("g", F.lit(1.0)).alias("g"))


# ---------------------------------------------------------------- scoring

def _packed_model(model: DataFrame, shards: int, copies: int) -> DataFrame:
    """One row per (shard, copy, language, level): its sorted keys and values."""
    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = batch.column("level").to_numpy().astype(np.uint8)
            keys = batch.column("key").to_numpy().view(np.uint64)
            yield batch.append_column("shard", pa.array(shard_of(levels, keys, shards), pa.int64()))

    sharded = model.mapInArrow(run, "lang string, level int, key long, a double, g double, shard long")
    # 65536 keys at most in a row, so no row outgrows what a task can hold
    packed = sharded.groupBy("shard", "lang", "level", (F.xxhash64("key") % F.lit(max(1, SHARD_GRAMS >> 16))).alias("part")).agg(
        F.collect_list(F.struct("key", F.col("a").cast("float").alias("a"), F.col("g").cast("float").alias("g"))).alias("rows"))
    return packed.select("shard", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("kind"),
                         F.lit(None).cast("long").alias("page"), "lang", "level", "rows",
                         F.lit(None).cast("binary").alias("levels"), F.lit(None).cast("binary").alias("keys"))


def perplexities(docs: DataFrame, model: DataFrame, limit: int = PAGE_CHARS) -> DataFrame:
    """(doc_id, lang, perplexity) per row of ``docs`` (doc_id, lang, text); null without a model for the language."""
    model = store(model, "model")
    shards = max(8, -(-model.count() // SHARD_GRAMS))
    # a shard goes to several tasks, each with its own copy, when there are more tasks than shards
    copies = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)

    @handing_back
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for page, lang, _, texts in _pages(batches, limit):
            levels, keys, shard = Grams(texts).requests(shards)
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            parts = [(s, slice(cuts[s], cuts[s + 1])) for s in range(shards) if cuts[s] < cuts[s + 1]]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([s for s, _ in parts], pa.int64()), "page": pa.array([page] * len(parts), pa.int64()),
                "lang": pa.array([lang] * len(parts), pa.string()),
                "levels": pa.array([levels[x].tobytes() for _, x in parts], pa.binary()),
                "keys": pa.array([keys[x].tobytes() for _, x in parts], pa.binary())})

    @handing_back
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tables = None, {}
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            shard_of_row, copy_of_row, kinds, langs, pages = (
                columns[c].to_pylist() for c in ("shard", "copy", "kind", "lang", "page"))
            for i, shard in enumerate(shard_of_row):
                if held != (shard, copy_of_row[i]):
                    held, tables = (shard, copy_of_row[i]), {}
                if kinds[i] == 0:
                    rows = columns["rows"][i].values
                    part = [rows.field(n).to_numpy(zero_copy_only=False) for n in ("key", "a", "g")]
                    tables.setdefault((langs[i], columns["level"][i].as_py()), []).append(part)
                    continue
                keys = np.frombuffer(columns["keys"][i].as_py(), np.uint64)
                levels = np.frombuffer(columns["levels"][i].as_py(), np.uint8)
                a, g = np.zeros(len(keys), np.float32), np.ones(len(keys), np.float32)
                for level in np.unique(levels).tolist():
                    table = tables.get((langs[i], level))
                    if table is None:
                        continue
                    if isinstance(table, list):
                        table = [np.concatenate([p[k] for p in table]) for k in range(3)]
                        order = np.argsort(table[0].view(np.uint64))
                        table = tables[(langs[i], level)] = (table[0].view(np.uint64)[order], table[1][order], table[2][order])
                    mine = np.flatnonzero(levels == level)
                    at = np.minimum(np.searchsorted(table[0], keys[mine]), len(table[0]) - 1)
                    hit = table[0][at] == keys[mine]
                    a[mine[hit]], g[mine[hit]] = table[1][at[hit]], table[2][at[hit]]
                yield pa.RecordBatch.from_pydict({
                    "page": pa.array([pages[i]], pa.int64()), "shard": pa.array([shard], pa.int64()),
                    "a": pa.array([a.tobytes()], pa.binary()), "g": pa.array([g.tobytes()], pa.binary())})

    @handing_back
    def text_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(3).compress
        for page, lang, ids, texts in _pages(batches, limit):
            sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_pydict({
                "page": pa.array([page], pa.int64()), "lang": pa.array([lang], pa.string()),
                "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "texts": pa.array([squeeze("".join(t or "" for t in texts).encode("utf-8", "surrogatepass"))], pa.binary())})

    def score(page: pa.Table, answers: pa.Table) -> pa.Table:
        import zstandard

        ids, sizes = page["ids"][0].as_py(), page["sizes"][0].as_py()
        raw = zstandard.ZstdDecompressor().decompress(page["texts"][0].as_py())
        cuts = np.cumsum([0, *sizes]).tolist()
        texts = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(cuts, cuts[1:])]
        got = [(s.as_py(), np.frombuffer(a.as_py(), np.float32), np.frombuffer(g.as_py(), np.float32))
               for s, a, g in zip(answers["shard"], answers["a"], answers["g"])]
        values = Grams(texts).perplexities(shards, got)
        hand_back()
        return pa.table({"doc_id": pa.array(ids, pa.int64()),
                         "lang": pa.array([page["lang"][0].as_py()] * len(ids), pa.string()),
                         "perplexity": pa.array([float(v) if np.isfinite(v) else None for v in values], pa.float64())})

    picked = _numbered(docs)
    requests = picked.mapInArrow(ask, "shard long, page long, lang string, levels binary, keys binary")
    asked = requests.select("shard", F.pmod("page", F.lit(copies)).cast("int").alias("copy"), F.lit(1).alias("kind"), "page",
                            "lang", F.lit(None).cast("int").alias("level"),
                            F.lit(None).cast("array<struct<key:long,a:float,g:float>>").alias("rows"), "levels", "keys")
    met = (_packed_model(model, shards, copies).unionByName(asked).repartition("shard", "copy")
           .sortWithinPartitions("shard", "copy", "kind"))
    answers = met.mapInArrow(answer, "page long, shard long, a binary, g binary")
    pages = picked.mapInArrow(text_pages, "page long, lang string, ids array<long>, sizes array<long>, texts binary")
    return pages.groupBy("page").cogroup(answers.groupBy("page")).applyInArrow(
        score, "doc_id long, lang string, perplexity double")


# ---------------------------------------------------------------- classification

def _bit_positions(column: str) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(k), column), F.lit(FILTER_BITS)) for k in (1, 2, 3)])


def trusted_documents(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """(doc_id, lang, packed) of the rows of ``docs`` whose doc_id is among the trusted ones; texts compressed.

    The driver holds a filter of ``FILTER_BITS`` bits, whatever the number of ids; rows
    it lets through by chance fall out in the exact semi-join.
    """
    ids = trusted_ids.select("doc_id").where("doc_id is not null").distinct()
    words = ids.select(F.explode(_bit_positions("doc_id")).alias("bit")).groupBy(
        F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        table[r.word] = r.bits
    shared = docs.sparkSession.sparkContext.broadcast(table)
    hashed = docs.withColumn("_bits", _bit_positions("doc_id"))

    @handing_back
    def may_be(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        words, squeeze = shared.value, zstandard.ZstdCompressor(6).compress
        for batch in batches:
            bits = batch.column("_bits").flatten().to_numpy()
            on = ((words[bits >> 6] >> (bits & 63)) & 1).reshape(-1, 3).all(axis=1)
            some = batch.filter(pa.array(on))
            packed = [squeeze((t or "").encode("utf-8", "surrogatepass")) for t in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": some.column("doc_id"), "lang": some.column("lang"),
                                              "packed": pa.array(packed, pa.binary())})

    return hashed.mapInArrow(may_be, "doc_id long, lang string, packed binary").join(ids, "doc_id", "left_semi")


def classify(docs: DataFrame, trusted_ids: DataFrame, quantiles: tuple[float, float] = QUANTILES, text: str = "text",
             lang: str = "lang", id_column: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, lang, perplexity, the limits of its language, and ``keep``.

    ``trusted_ids`` has the doc_id of the documents to learn from. A row is kept unless its
    perplexity lies outside the limits; without a perplexity or limits it is kept.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    model = train(trusted_documents(rows, trusted_ids))
    scores = store(perplexities(rows, model), "perplexities")
    known = scores.join(trusted_ids.select("doc_id").distinct(), "doc_id", "left_semi").where("perplexity is not null")
    limits = store(known.groupBy(F.col("lang").alias("of")).agg(
        F.percentile_approx("perplexity", list(quantiles), F.lit(100_000)).alias("limit")), "limits")
    if limits.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES:
        limits = F.broadcast(limits)  # else the join shuffles
    return scores.join(limits, F.col("lang") == F.col("of"), "left").select(
        "doc_id", "lang", "perplexity", F.col("limit")[0].alias("low"), F.col("limit")[1].alias("high"),
        F.coalesce(F.col("perplexity").between(F.col("limit")[0], F.col("limit")[1]), F.lit(True)).alias("keep"))


def keep_good(docs: DataFrame, trusted_ids: DataFrame, quantiles: tuple[float, float] = QUANTILES) -> DataFrame:
    """The rows of ``docs`` (doc_id, lang, text and others) that the classifier keeps.

    Rows that share an id share the decision: they go only if all of them are rejected.
    Rows without an id stay.
    """
    judged = classify(docs, trusted_ids, quantiles).groupBy("doc_id").agg(F.max("keep").alias("keep"))
    return docs.join(judged.where("not keep").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
