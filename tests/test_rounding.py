from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from layerlint.functions.rounding import progress_percentage, round_half_up_2, share_exceeds


def test_exact_half_up(spark):
    values = [i / 20000 * 100 for i in range(0, 3000)] + [1001 / 20000 * 100, 5.005, 0.125, 0.375, 1e6 / 3, 99.995, 0.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_half_up_2(F.col("v")).alias("r")).collect()
    for row in rows:
        assert row.r == float(Decimal(row.v).quantize(Decimal("0.01"), ROUND_HALF_UP)), row.v
    assert dict((r.v, r.r) for r in rows)[1001 / 20000 * 100] == 5.0


def test_share(spark):
    rows = spark.createDataFrame([(5, 100), (6, 100), (0, 0), (5, 0), (None, 10)], "n long, t long")
    assert [r.x for r in rows.select(share_exceeds(F.col("n"), F.col("t"), 5).alias("x")).collect()] == [False, True, False, False, False]


def test_progress(spark):
    rows = spark.createDataFrame([(75.5,), (33.33,), (66.67,), (0.0,), (100.0,)], "v double")
    assert [r.p for r in rows.select(progress_percentage(F.col("v")).alias("p")).collect()] == [76, 33, 67, 0, 100]
