from pyspark.sql import functions as F

from checks import registry


def test_each_part_is_made_when_it_comes_and_rows_are_written_once(spark, tmp_path):
    rows = spark.range(40).select("id", (F.col("id") * 2).alias("twice"))
    folder, seen = f"file://{tmp_path}/in", []

    class Started:
        def awaitTermination(self):
            seen.append(spark.read.parquet(folder).count())

    registry._arrive(spark, folder, rows, F.pmod("id", F.lit(registry.STREAM_PARTS)), Started)
    assert seen == [10, 20, 30, 40] and [p.name for p in tmp_path.iterdir()] == ["in"]
    assert sorted(r.twice for r in spark.read.parquet(folder).collect()) == [2 * i for i in range(40)]
