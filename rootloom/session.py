"""Session settings and the guards every job shares: checkpoints, broadcasts and hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows of a key that one task takes, and how many keys can hold more than that at most.
HOT_ROWS, MOST_HOT = 100_000, 10_000


def build_session(app: str = "rootloom", master: str | None = None, partitions: int | None = None,
                  memory: str | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.ui.enabled", "false"))
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a folder of this machine only where Spark runs in this one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    sc.setCheckpointDir(folder)


def held(df: DataFrame) -> DataFrame:
    """df computed once into the shared checkpoint folder, for results that are read several times.

    A lost executor costs nothing, no memory is pinned, and where spark.cleaner.referenceTracking.cleanCheckpoints is
    set (as build_session does) the files go when nothing refers to the result any more.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read back, for loops that join their own results.

    A checkpoint keeps the estimated size of its plan, and that of a join is the product of both sides: its digits double
    each round, until planning takes longer than the work. Files have the size they have. They stay as long as the folder.
    """
    path = scratch(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measured, not estimated: rows and bytes of a request-like table."""
    probe = df.limit(max_rows + 1).agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b"),
    ).first()
    return probe["n"] <= max_rows and probe["b"] <= max_bytes


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches of texts hold at most so many rows: their buffers lie outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                       max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the table was measured to be small.

    Larger inputs come back unhinted, so the join shuffles (and AQE splits skew).
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def dealt_join(heavy: DataFrame, light: DataFrame, key: str, spread_by: str, sizes: DataFrame | None = None,
               most: int | None = None) -> DataFrame:
    """Inner join on ``key`` of which no task gets much more than ``most`` heavy rows of one key.

    A light side measured to be small is broadcast. Otherwise the rows of keys with more are dealt by a hash of
    ``spread_by`` and the light rows of these keys, which are few, are copied to every deal. ``sizes`` (key, n) are
    the heavy rows per key, counted here if not given.
    """
    if is_small(light):
        return heavy.join(F.broadcast(light), key)
    if sizes is None:
        sizes = heavy.groupBy(key).agg(F.count("*").alias("n"))
    sizes = held(sizes.select(key, F.col("n").alias("_n")))
    # no more than MOST_HOT keys can hold more than total / MOST_HOT rows each
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    most = max(most or HOT_ROWS, total // MOST_HOT)
    hot = F.broadcast(sizes.where(F.col("_n") > most).select(key, F.ceil(F.col("_n") / most).cast("int").alias("_deals")))
    deals = F.coalesce("_deals", F.lit(1))
    dealt = heavy.join(hot, key, "left").withColumn("_deal", F.pmod(F.xxhash64(spread_by), deals).cast("int")).drop("_deals")
    copied = light.join(hot, key, "left").withColumn("_deal", F.explode(F.sequence(F.lit(0), deals - 1))).drop("_deals")
    return dealt.join(copied, [key, "_deal"]).drop("_deal")


def ranked(df: DataFrame, order: list[str], column: str) -> DataFrame:
    """df with its rows' places (from 0) in the order of the columns; equal rows in any order.

    Rows are dealt to ranges and sorted there; what the driver sees is one count per range. df runs twice, so it should be cheap.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = held(rows.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(2 ** 33 - 1)))
    begin, begins = 0, []
    for r in rows.groupBy("_range").count().orderBy("_range").collect():
        begins.append((r["_range"], begin))
        begin += r["count"]
    begins = F.broadcast(spark.createDataFrame(begins, "_range long, _begin long"))  # a row per range
    return rows.join(begins, "_range").withColumn(column, F.col("_begin") + F.col("_at")).drop("_range", "_at", "_begin")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
