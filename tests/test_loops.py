"""Loops whose planning must not grow with their rounds."""

from pyspark.sql import functions as F

from rootloom.operators import origins


def test_results_of_a_loop_have_the_size_of_their_files(spark):
    """A checkpoint keeps the estimated size of its plan; joined with itself, its digits double each round."""
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    for _ in range(7):
        df = origins.held(df.join(df.select("id"), "id"))
    assert df.count() == 100
    assert int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1_000_000
