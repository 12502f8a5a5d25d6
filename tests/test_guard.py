from pyspark.sql import functions as F

from rivalry.plans.guard import bounded_broadcast


def counted(spark, n):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def touch(x):
        seen.add(1)
        return x
    return spark.range(n).select(touch("id").alias("id")), seen


def test_a_large_side_is_computed_once(spark):
    side, seen = counted(spark, 3000)
    frame, broadcasted = bounded_broadcast(side, max_rows=10_000, local_rows=1000)
    assert broadcasted and frame.count() == 3000 and seen.value == 3000


def test_bytes_bound_the_broadcast(spark):
    wide = spark.range(2000).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    for local in (10, 5000):
        frame, broadcasted = bounded_broadcast(wide, local_rows=local, max_bytes=100_000)
        assert not broadcasted and frame.count() == 2000
    assert bounded_broadcast(wide, local_rows=5000)[1]
