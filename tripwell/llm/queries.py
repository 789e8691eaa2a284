"""The corpus operators bound to the sample tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.llm import (
    hard_negatives, language, lattice, lexical, license_scan, mixing, neighbours, packing, pieces, pii, quality, simhash,
    substrings,
)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents labelled good and not toxic."""
    return table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of its language, and whether it is kept."""
    return quality.classify(table(spark, sf_dir, "documents"), trusted(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id reachable by links of at most 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, with its source's size and target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = mixing.sized_rows(docs, mixing.word_count(F.col("text")), F.array("source"))
    mix = mixing.plan_mix(rows)
    sources = spark.createDataFrame([(s, *v) for s, v in mix.sources.items()] or [(None, 0, 0.0)],
                                    "source string, source_size long, target double")
    taken = rows.withColumn("source", F.get(F.from_json("_mix_pattern", "array<string>"), F.lit(0))).join(
        F.broadcast(mix.decisions), "_mix_pattern").join(
        F.broadcast(sources.withColumnRenamed("source", "name")), F.col("source").eqNullSafe(F.col("name")))
    return taken.select("doc_id", F.col("_mix_size").alias("size"), "source_size", "target",
                        (mixing.copies_of_keyed() * F.col("_mix_size")).alias("taken"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids cut into sequences of at most 2048 along a Hilbert curve."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 or more of every vector and the smallest id reachable by them."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base kinds, and all spans."""
    return pii.scan_personal_data(table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without those in windows of 50 words that an earlier document holds."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of largest inner product for every vector whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from documents whose id's checksum leaves another rest than 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    net = language.learn(docs, F.coalesce(~held_out, F.lit(False)))
    found = language.identify(docs, net, spans=False)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document, with the sentence identifiers that show them."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_ids", "wrapped_ids", F.array_join("licenses", ",").alias("licenses"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's piece ids and of the text they decode to; ``covered`` is the last byte under a piece."""
    found = pieces.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    names = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(names, 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
                        F.element_at("ends", -1).cast("long").alias("covered"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five positives of every anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents of highest score for every item of the benchmark."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op10_license_scan": license_scan.oracle(), "op12_hard_negatives": hard_negatives.oracle(),
            "op13_lexical": lexical.oracle()}
