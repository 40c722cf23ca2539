"""What the operators share: the shared scratch folder, stored tables and word patterns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]+"
LEAST_ID = -(2 ** 63)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share (spark.checkpoint.dir).

    A folder of this machine is used only where none is set and Spark runs in this one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and lost executors cost nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fingerprint(column: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a value: together its 128-bit identity."""
    return F.xxhash64(column), F.xxhash64(F.lit("second"), column)


def word_hashes(column: str = "text") -> Column:
    """Hashes of the words (runs without white space) in order; null and empty texts give none."""
    return F.transform(F.array_remove(F.split(text_of(column), SPACE), ""), lambda w: F.xxhash64(w))


def window_hashes(words, length: int, multiplier: int):
    """Polynomial hashes modulo 2^64 of every run of `length` word hashes, by doubling."""
    import numpy as np
    result, done, power = None, 0, 1
    block, size, base = words, 1, multiplier
    mask = 2 ** 64 - 1
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    rest = length
    while rest:
        if rest & 1:
            part = block[done:done + n]
            result = part.copy() if result is None else result * np.uint64(base) + part
            done += size
        rest >>= 1
        if rest:
            block = block[:len(block) - size] * np.uint64(base) + block[size:]
            size, base = size * 2, base * base & mask
    return result


def slices(batch, column: int, most: int = 1 << 19):
    """A batch in parts of about `most` list values, so that a task's memory doesn't follow the batch."""
    import numpy as np
    ends = np.cumsum(batch.column(column).value_lengths().to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches of long lists hold at most so many rows: their buffers lie outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def forget(df: DataFrame) -> None:
    """Delete the files of a table that `stored` wrote and nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, order: list[str], column: str, name: str) -> DataFrame:
    """df, stored, with its rows' places (from 0) in the order of the columns; equal rows in any order.

    Rows are dealt to ranges and sorted there; what the driver sees is one count per range. df runs twice, so it should be cheap.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = stored(rows.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(2 ** 33 - 1)), name)
    begin, begins = 0, []
    for r in rows.groupBy("_range").count().orderBy("_range").collect():
        begins.append((r["_range"], begin))
        begin += r["count"]
    begins = F.broadcast(spark.createDataFrame(begins, "_range long, _begin long"))  # a row per range
    return rows.join(begins, "_range").withColumn(column, F.col("_begin") + F.col("_at")).drop("_range", "_at", "_begin")
