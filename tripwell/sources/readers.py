"""Reading delimited text and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwell.sources.storage import new_path


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the file(s) as one string column ``value``."""
    return spark.read.text(path)


def header_line(lines: DataFrame) -> str:
    """The first line. Each part of a multi-file input starts with the header."""
    first = lines.first()
    if first is None:
        raise ValueError("input has no lines, so there is no header")
    return first["value"]


def header_schema(header: str) -> T.StructType:
    """All-string, nullable schema from a header line; double quotes are stripped."""
    return T.StructType([T.StructField(name.strip('"'), T.StringType(), True)
                         for name in header.split(",")])


def drop_malformed(lines: DataFrame, header: str) -> DataFrame:
    """Split on commas, keep lines with as many fields as the header.

    Lines equal to the header are dropped wherever they occur. Quotes have no
    meaning, so a quoted comma makes a line malformed. Empty fields stay ``''``.
    """
    width = len(header.split(","))
    fields = F.split(F.col("value"), ",", -1)
    return (lines.filter(F.col("value") != F.lit(header))
            .select(fields.alias("fields"))
            .filter(F.size("fields") == width))


def rows_to_table(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Turn a ``fields`` array column into named columns of ``schema``."""
    return rows.select(*[F.col("fields").getItem(i).cast(f.dataType).alias(f.name)
                         for i, f in enumerate(schema.fields)])


def ingest_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Raw delimited file to an all-string table, without a Python worker."""
    lines = scan_text_lines(spark, path)
    header = header_line(lines)
    return rows_to_table(drop_malformed(lines, header), header_schema(header))


def scan_csv_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, every column a string."""
    return spark.read.option("header", "true").csv(path)


# Kinds of text a column may hold, as bits: a union of kinds is the bitwise or, in any order.
INT, LONG, WHOLE, REAL, DATE, STAMP, TRUTH, TEXT = (1 << i for i in range(8))


def text_kind(value: Column) -> Column:
    """The narrowest kind of one field; null for an empty one."""
    whole, real = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    number = (F.when(value.try_cast("int").isNotNull(), INT).when(value.try_cast("bigint").isNotNull(), LONG)
              .when(F.length(value) <= 38, WHOLE).otherwise(REAL))
    return (F.when(value.isNull() | (value == ""), F.lit(None)).when(value.rlike(whole), number)
            .when(value.rlike(real) | value.isin("NaN", "Inf", "-Inf", "Infinity", "-Infinity"), REAL)
            .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), DATE)
            .when(value.rlike(r"^[0-9]{4}-") & value.try_cast("timestamp").isNotNull(), STAMP)
            .when(F.lower(value).isin("true", "false"), TRUTH).otherwise(TEXT))


def type_of_kinds(kinds: int | None) -> str:
    """Narrowest type that holds every kind of a union; a column without values is a string."""
    for allowed, name in ((INT, "int"), (INT | LONG, "bigint"), (INT | LONG | WHOLE, "decimal(38,0)"),
                          (INT | LONG | WHOLE | REAL, "double"), (DATE, "date"), (DATE | STAMP, "timestamp"),
                          (TRUTH, "boolean")):
        if kinds and kinds & ~allowed == 0:
            return name
    return "string"


def scan_csv_infer(spark: SparkSession, path: str, stored: str | None = None) -> DataFrame:
    """CSV with a header line and inferred types; empty fields are null.

    The text is parsed once: while its fields are written to Parquet below the fresh
    folder ``stored`` (by default in the shared one), the same job merges the kinds
    found per column. The result reads that table, so columns prune, and casts it.
    """
    fields = scan_csv_header(spark, path)
    stored = stored or new_path(spark, "typed-csv")
    names = [f"c{i}" for i in range(len(fields.columns))]  # any header name, also with points
    if not names:
        return fields
    kinds = Observation()
    (fields.toDF(*names).observe(kinds, *[F.bit_or(text_kind(F.col(n))).alias(n) for n in names])
     .write.parquet(stored))
    types = {n: type_of_kinds(k) for n, k in kinds.get.items()}
    table = spark.read.schema(", ".join(f"{n} string" for n in names)).parquet(stored)
    return table.select(*[_typed(F.col(n), types[n]).alias(c) for n, c in zip(names, fields.columns)])


def _typed(value: Column, target: str) -> Column:
    value = F.nullif(value, F.lit(""))
    if target == "double":  # the short names of infinity are no numbers to a cast
        value = F.regexp_replace(value, "^(-?)Inf$", "$1Infinity")
    return value.cast(target)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def relaxed_schema(footer: T.StructType) -> T.StructType:
    """Reading schema derived from the file's own one.

    64-bit integers and timestamps read as long, 32-bit integers as int, double
    and string stay, anything else is read as double.
    """
    def reading_type(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, (T.LongType, T.TimestampType, T.TimestampNTZType)):
            return T.LongType()
        if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
            return T.IntegerType()
        if isinstance(dtype, (T.DoubleType, T.StringType)):
            return dtype
        return T.DoubleType()

    return T.StructType([T.StructField(f.name, reading_type(f.dataType), True) for f in footer.fields])


def epoch_micros(name: str, dtype: T.DataType) -> Column:
    """Stored integer of a timestamp column; zone-free timestamps count as UTC."""
    col = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        col = F.convert_timezone(F.lit("UTC"), F.current_timezone(), col)
    return F.unix_micros(col.cast("timestamp"))


def scan_parquet_imposed_schema(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet with the relaxed schema of its footer imposed on it.

    Timestamps arrive as their stored integers. Nanosecond timestamps, which
    Spark has no type for, are readable once they count as plain longs. There is
    no option of the reader for that, so the session switch is turned on, and only
    for files that cannot be read without it.
    """
    try:
        footer = spark.read.parquet(path).schema
    except AnalysisException:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
        footer = spark.read.parquet(path).schema
    own = {f.name: f.dataType for f in footer.fields}
    stamps = {n for n, d in own.items() if isinstance(d, (T.TimestampType, T.TimestampNTZType))}
    return spark.read.schema(footer).parquet(path).select(*[
        (epoch_micros(f.name, own[f.name]) if f.name in stamps
         else F.col(f.name).cast(f.dataType)).alias(f.name)
        for f in relaxed_schema(footer).fields])
