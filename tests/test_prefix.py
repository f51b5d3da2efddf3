"""Blocked numbering and running values equal plain windows, however the blocks fall and however hot a key is."""

import random

import pytest
from pyspark.sql import Window, functions as F

from layerlint.operators.prefix import number_rows, running


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = [(0 if rnd.random() < 0.6 else rnd.randrange(20), p, rnd.randrange(-5, 9)) for p in rnd.sample(range(5000), 900)]
    return spark.createDataFrame(data, "k int, p long, v long").repartition(7)


@pytest.mark.parametrize("bits", [0, 3, 6, 20])
def test_number_rows(rows, bits):
    plain = rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("p")) - 1)
    blocked = number_rows(rows, ["k"], ["p"], F.shiftright("p", bits), "n")
    assert sorted(blocked.select("k", "p", "v", "n").collect()) == sorted(plain.collect())


@pytest.mark.parametrize("size", [1, 10, 300, 10**6])
def test_running(rows, size):
    w = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.select("k", "p", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"))
    blocked = running(rows, ["k"], "p", F.floor(F.col("p") / size), sums={"s": "v"}, maxima={"m": "v"})
    assert sorted(blocked.select("k", "p", "s", "m").collect()) == sorted(plain.collect())
