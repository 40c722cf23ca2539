"""JSON-lines scan with physical line numbers, and JSON/Parquet writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, raw): zero-based physical line numbers per file, blanks counted.

    A split numbers its own lines; only per-split counts (one row per split) are
    added up, so no file passes through one task.
    """
    mid = F.monotonically_increasing_id()
    lines = spark.read.text(path).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), mid.alias("mid"))
    splits = lines.groupBy("file", "block").agg(F.min("mid").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return lines.join(splits.drop("n"), ["file", "block"]).select(
        "file", (F.col("mid") - F.col("first") + F.col("offset")).alias("line_no"), "raw")


def parse_json_lines(lines: DataFrame, schema: StructType, on_bad: str = "count") -> DataFrame:
    """Typed columns from a ``raw`` column; blank lines are skipped.

    ``on_bad``: ``count`` keeps malformed lines with ``is_malformed``, ``drop``
    removes them, ``fail`` stops the job at the first one.
    """
    if on_bad not in ("count", "drop", "fail"):
        raise ValueError(f"on_bad: {on_bad}")
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = lines.where(F.trim("raw") != "").withColumn("j", F.from_json("raw", full, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col(f"j.{CORRUPT}").isNotNull()
    if on_bad == "drop":
        parsed = parsed.where(~bad)
    if on_bad == "fail":
        parsed = parsed.withColumn("j", F.when(bad, F.raise_error(F.concat(
            F.lit("malformed line "), F.col("line_no").cast("string")))).otherwise(F.col("j")))
    return parsed.select(*lines.columns, bad.alias("is_malformed"),
                         *(F.col(f"j.{f.name}").alias(f.name) for f in schema.fields))


def read_jsonl(spark: SparkSession, path: str, schema: StructType, on_bad: str = "count") -> DataFrame:
    """Scan of JSON-lines files with the physical ``line_no`` of each row."""
    return parse_json_lines(numbered_lines(spark, path), schema, on_bad)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def resolve_corpus(spark: SparkSession, corrected: str, original: str, schema: StructType,
                   on_bad: str = "count") -> tuple[DataFrame, str]:
    """Corrected corpus, else the original, else no rows with a load error."""
    for status, path in (("CORRECTED", corrected), ("ORIGINAL", original)):
        if path_exists(spark, path):
            df = read_jsonl(spark, path, schema, on_bad)
            return df.withColumn("load_status", F.lit(status)), status
    empty = StructType([*StructType.fromDDL(
        "file string, line_no long, raw string, is_malformed boolean").fields, *schema.fields])
    df = spark.createDataFrame([], empty)
    return df.withColumn("load_status", F.lit("LOAD_ERROR")), "LOAD_ERROR"


def write_jsonl(df: DataFrame, path: str, per: str | None = None) -> None:
    """JSON lines; ``per`` (for example the root) gives one folder per value."""
    writer = df.write.mode("errorifexists").option("ignoreNullFields", "true")
    (writer.partitionBy(per) if per else writer).json(path)


def write_tables(tables: dict[str, DataFrame], folder: str, sort_key: str | None = None) -> None:
    """Parquet tables; sorting inside partitions gives tight min/max for key lookups."""
    for name, df in tables.items():
        out = df.sortWithinPartitions(sort_key) if sort_key and sort_key in df.columns else df
        out.write.mode("errorifexists").parquet(f"{folder}/{name}")
