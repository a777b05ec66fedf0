from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import ordering as O


def scanned(df) -> int:
    """Rows the scan itself read to answer a query."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def table(spark, n=20_000):
    """Two columns in unrelated orders; even ids only."""
    mixed = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    return spark.range(n).select((F.col("id") * 2).alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + mixed).alias("t"), F.hex("id").alias("name"))


def test_a_point_and_a_range_each_skip_most_files(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "t")
    O.write_indexed(df, path, ["k", "t"], files=64, point=["k"])
    stored = spark.read.parquet(path)
    assert rows(stored) == rows(df)
    point = stored.filter("k = 20000")
    assert point.count() == 1 and scanned(point) <= 20_000 / 4
    span = stored.filter(F.col("t").between(F.timestamp_seconds(F.lit(1_700_300_000)), F.timestamp_seconds(F.lit(1_700_330_000))))
    assert span.count() > 300 and scanned(span) <= 20_000 / 4
    assert scanned(stored.filter("k = 20001")) == 0, "inside the bounds of files, but in none of their filters"


def test_files_are_even_also_with_a_hot_value(spark):
    hot = table(spark).withColumn("k", F.when(F.col("k") % 3 == 0, 5000).otherwise(F.col("k")))
    sizes = [r.n for r in O.interleaved(hot, ["k", "t"], 16).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 16


def test_texts_nulls_repeats_and_empty_tables(spark):
    odd = spark.createDataFrame([("b", 1), ("b", 1), (None, None), ("", -5), ("a longer text", 3)], "name string, n int")
    assert rows(O.interleaved(odd, ["name", "n"], 4)) == rows(odd)
    assert O.interleaved(odd.filter("1 = 0"), ["name", "n"], 4).count() == 0
    wide = spark.range(2000).select(F.lpad(F.hex("id"), 6, "0").alias("name"), F.lit(1).alias("n"))
    parts = O.interleaved(wide, ["name", "n"], 8).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("*").alias("n"))
    assert max(r.n for r in parts.collect()) < 2 * 2000 / 8
