from pyspark.sql import Window
from pyspark.sql import functions as F

from leadloom.operators.ranking import with_position


def test_positions_equal_a_window_even_with_one_hot_value(spark):
    rows = spark.range(500).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("c"), F.col("id") % 7)).alias("city"),
        (F.col("id") * 7919 % 13).alias("score"),
    )
    order = [F.col("score").desc(), F.col("id").asc()]
    got = with_position(rows, order, "place", within=["city"])
    expected = rows.withColumn("place", F.row_number().over(Window.partitionBy("city").orderBy(*order)).cast("bigint"))
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_positions_over_everything(spark):
    rows = spark.range(200).select((F.col("id") * 37 % 200).alias("id"))
    got = with_position(rows, [F.col("id").desc()], "place").collect()
    assert all(r.place == 200 - r.id for r in got)
