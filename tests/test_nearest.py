"""nearest: rows against a loop, and what its tasks shuffle."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.test_engine import written_by
from veinstone.operators import joins


@pytest.mark.parametrize("limits", [{}, {"FEW": 1, "WORK": 1}, {"FEW": 1, "WORK": 1, "ARRAYS": 0}, {"FEW": 1, "WORK": 1, "MOST": 2, "ROUNDS": 3}, {"FEW": 0, "WORK": 0, "SPREAD": 0}])
def test_nearest_of_odd_and_many_rows(spark, monkeypatch, limits):
    """Cut cells, shuffled arrays and cells that go by pairs give what a loop gives, also for ties, copies, outliers and what is not finite."""
    r, nan, inf = random.Random(7), float("nan"), float("inf")
    for name, value in limits.items():
        monkeypatch.setattr(joins, name, value)
    rows = [(f"k{i}", r.randint(0, 40) * 1.0, r.randint(0, 400) / 10) for i in range(150)] + [("far", 1e300, -7.0), ("far2", -1e15, 3.25), ("zero", -0.0, 0.0)]
    rows += [("n1", nan, 2.0), ("n2", nan, nan), ("i1", inf, 2.0), ("i2", -inf, inf), ("none", None, 1.0)]
    finite = [(i, r.randint(0, 8) * 5.0, r.randint(0, 800) / 20) for i in range(90, 10, -1)] + [(91, 5.0, 5.0), (3, 5.0, 5.0), (92, None, 1.0)]
    odd = [(2, nan, 1.0), (95, inf, 1.0), (96, inf, 0.0), (1, -inf, inf)]
    order = lambda d: (math.isnan(d), 0 if math.isnan(d) else d)  # noqa: E731 - NaN last
    for golds in (finite + odd, odd, [(5, 9.0, 9.0), (4, 9.0, 9.0)]):
        want = {}
        for k, x, y in rows:
            seen = [(order(round(abs(x - gx) + abs(y - gy), 9)), i, gx, gy) for i, gx, gy in golds if gx is not None] if x is not None else []
            want |= {k: (min(seen)[1], f"e{min(seen)[1]}", k[0])} if seen else {}
        p = spark.createDataFrame([(*t, t[0][0]) for t in rows], "k string, x double, y double, own string")
        g = spark.createDataFrame([(*t, f"e{t[0]}") for t in golds], "gold_id long, x double, y double, ge string")
        got = joins.nearest(p, g, "x", "y", "k", 4.0, ("own",), ("ge",)).collect()
        assert len(got) == len(want) and {t["k"]: (t["gold_id"], t["ge"], t["own"]) for t in got} == want


def test_nearest_shuffles_no_rows(spark):
    """Rows meet the gold rows of their cell where they are read: cells and gold rows are shuffled, rows and pairs are not."""
    rows = spark.range(160000).select(F.concat(F.lit("key of a row, "), "id").alias("k"), (F.col("id") % 50).cast("double").alias("x"), (F.xxhash64("id") % 100000 / 1000).alias("y"))
    gold = spark.range(2000).select(F.col("id").alias("gold_id"), (F.col("id") % 5 * 12.0).alias("x"), (F.xxhash64("id") % 1000 / 10).alias("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = []
        assert written_by(spark, lambda: near.append(joins.nearest(rows, gold, "x", "y", "k", 4.0).agg(F.count("k")).first()[0])) < 5_000_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert near == [160000]
