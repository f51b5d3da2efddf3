"""Splitting hot keys changes no result."""

import random

import pytest

from layerlint.operators.skew import split_join


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [5, 40, 10**6])
def test_split_join(spark, how, hot):
    rnd = random.Random(hot)
    left = spark.createDataFrame([(0 if rnd.random() < 0.4 else rnd.randrange(1, 30), i) for i in range(400)], "k int, i int")
    right = spark.createDataFrame([(k, k * 10 + j) for k in range(0, 30, 2) for j in range(1 + k % 3)], "k int, v int")
    plain = left.join(right, "k", how)
    assert sorted(split_join(left, right, ["k"], how, hot).select(plain.columns).collect(), key=repr) == sorted(plain.collect(), key=repr)
