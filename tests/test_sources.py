"""Reading raw text, imposed schemas and the sinks."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripwell.sources import readers, sinks, storage


def test_ingest_drops_malformed_lines(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('"a",b,c\n1,2,3\n\n1,2\n1,2,3,4\n"x,y",2,3\n,,\n"a",b,c\n')
    df = readers.ingest_delimited(spark, str(path))
    assert df.columns == ["a", "b", "c"]
    assert {tuple(r) for r in df.collect()} == {("1", "2", "3"), ("", "", "")}
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}


def test_empty_input_has_no_header(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("")
    with pytest.raises(ValueError):
        readers.ingest_delimited(spark, str(path))


def test_csv_inference(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n2,y\n")
    assert dict(readers.scan_csv_infer(spark, str(path)).dtypes) == {"a": "int", "b": "string"}
    assert dict(readers.scan_csv_header(spark, str(path)).dtypes) == {"a": "string", "b": "string"}


def test_csv_inference_merges_kinds_in_any_order(spark, tmp_path):
    columns = {"small": ["1", "-2", ""], "long": ["3000000000", "1", "2"], "whole": ["1", "123456789012345678901", ""],
               "real": ["1", "1e3", "-Inf"], "day": ["2024-01-31", "", "2024-02-29"], "stamp": ["2024-01-31 10:00:00", "2024-02-01", ""],
               "truth": ["true", "False", ""], "mixed": ["1", "true", "x"], "late.day": ["2024-02-30", "2024-01-01", ""],
               "none": ["", "", ""], "wide": ["1", "9" * 40, "2"]}
    want = {"small": "int", "long": "bigint", "whole": "decimal(38,0)", "real": "double", "day": "date", "stamp": "timestamp",
            "truth": "boolean", "mixed": "string", "late.day": "string", "none": "string", "wide": "double"}
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
        folder = tmp_path / "".join(map(str, order))
        folder.mkdir()
        for k in order:  # one file a line, so that kinds of several tasks meet
            (folder / f"{k}.csv").write_text(",".join(columns) + "\n" + ",".join(c[k] for c in columns.values()) + "\n")
        df = readers.scan_csv_infer(spark, str(folder), str(tmp_path / f"typed{order[0]}"))
        assert dict(df.dtypes) == want
        rows = df.collect()
        assert sorted(r["real"] for r in rows) == [float("-inf"), 1.0, 1000.0]
        assert sorted((r["small"] for r in rows), key=str) == [-2, 1, None]
    blank = tmp_path / "blank.csv"
    blank.write_text("a,b\n")
    empty = readers.scan_csv_infer(spark, str(blank))
    assert dict(empty.dtypes) == {"a": "string", "b": "string"} and empty.count() == 0


def test_imposed_schema_reads_nanosecond_timestamps(spark, tmp_path):
    path = str(tmp_path / "nanos.parquet")
    table = pa.table({"t": pa.array([1_000_000_123], pa.timestamp("ns")), "f": pa.array([1.5], pa.float32()),
                      "i": pa.array([3], pa.int32()), "s": ["x"]})
    pq.write_table(table, path)
    df = readers.scan_parquet_imposed_schema(spark, path)
    assert dict(df.dtypes) == {"t": "bigint", "f": "double", "i": "int", "s": "string"}
    assert tuple(df.first()) == (1_000_000_123, 1.5, 3, "x")


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.sink_parquet_overwrite(spark.range(10), path)
    sinks.sink_parquet_overwrite(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_metrics_are_replaced_by_the_first_block_and_appended_after(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for _ in range(2):
        sinks.sink_metrics_append([spark.range(2), spark.range(3)], path)
    assert spark.read.parquet(path).count() == 5


def test_metrics_runs_survive_repeats_and_cuts(spark, tmp_path):
    path = str(tmp_path / "runs")
    blocks = [spark.range(2), spark.range(3), spark.range(4)]

    class Lost(Exception):
        pass

    class Failing:
        """A block whose write never starts."""

        def __getattr__(self, name):
            raise Lost

    def seen(run=None):
        return sorted((r["run"], r["block"], r["id"]) for r in sinks.read_metrics_runs(spark, path, run).collect())

    want = [("007", i, j) for i, n in enumerate((2, 3, 4)) for j in range(n)]
    sinks.append_metrics_run(blocks, path, "007")
    assert seen() == want
    sinks.append_metrics_run(blocks, path, "007")
    assert seen() == want
    for cut in (1, 2):  # killed between blocks: not seen, and the next try completes it
        with pytest.raises(Lost):
            sinks.append_metrics_run([*blocks[:cut], Failing()], path, "b")
        assert seen() == want
    sinks.append_metrics_run(blocks[:2], path, "b")
    assert seen("b") == [("b", i, j) for i, n in enumerate((2, 3)) for j in range(n)] and seen("007") == want
    with pytest.raises(ValueError):
        sinks.append_metrics_run([], path, "c")


def test_csv_extract_is_one_ordered_file(spark, tmp_path):
    path = tmp_path / "extract"
    sinks.sink_csv_extract(spark.range(50).repartition(4).withColumnRenamed("id", "n"), str(path), ["n"])
    files = list(path.glob("part-*.csv"))
    assert len(files) == 1
    assert files[0].read_text().split() == ["n", *map(str, range(50))]


def test_shared_root_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert storage.shared_root(spark) == configured.rstrip("/")
    storage.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()
    stored = storage.store(spark.range(5), "five")
    assert stored.count() == 5


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("day"))
    sinks.overwrite_partitions(rows, path, ["day"])
    files = {f for f in spark.read.parquet(path).inputFiles() if "day=2/" not in f}
    again = rows.where("day = 2 and id < 50").withColumn("id", F.col("id") + 1000)
    for _ in range(2):
        sinks.overwrite_partitions(again, path, ["day"])
    found = spark.read.parquet(path)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in rows.where("day <> 2").union(again).collect()}
    assert found.count() == rows.where("day <> 2").count() + again.count()
    assert {f for f in found.inputFiles() if "day=2/" not in f} == files
    sinks.overwrite_partitions(rows.where("id < 0"), path, ["day"])
    assert spark.read.parquet(path).count() == found.count()


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 700).alias("key"), F.col("id").alias("v"))
    left = sinks.store_bucketed(rows, str(tmp_path / "a"), "bucketed_a", ["key"], 8)
    right = sinks.store_bucketed(rows.withColumnRenamed("v", "w"), str(tmp_path / "b"), "bucketed_b", ["key"], 8)
    both = left.join(right.hint("merge"), "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange" not in _plan(both)
    assert both.agg(F.sum("n")).first()[0] == sum((2000 // 700 + (k < 2000 % 700)) ** 2 for k in range(700))
    assert len(left.inputFiles()) == 8


def test_a_hot_key_is_stored_without_buckets(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, None).otherwise(F.col("id")).alias("key"))
    assert sinks.bucket_skew(rows, ["key"], 8) > 4
    found = sinks.store_bucketed(rows, str(tmp_path / "hot"), "bucketed_hot", ["key"], 8)
    assert found.count() == 3000 and found.where("key is null").count() == 2000
    assert not spark.catalog.tableExists("bucketed_hot")
    empty = sinks.store_bucketed(rows.where("key < 0"), str(tmp_path / "none"), "bucketed_none", ["key"], 8)
    assert empty.count() == 0


def test_buckets_grow_with_the_rows(spark):
    rows = spark.range(1000)
    assert sinks.bucket_count(rows) == 8
    assert sinks.bucket_count(rows, each=30) == 34
