"""Mergeable co-moments against the batch correlation."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from pairflow.operators import moments as m
from pairflow.session import scratch_path

SCHEMA = "execution_date date, base_return_1m double, ref_return_1m double"


def test_large_means_and_tiny_variances_keep_their_digits(spark):
    import datetime as dt
    rng = random.Random(3)
    rows = []
    for d in range(4):
        for i in range(400):
            x = rng.gauss(0, 1e-3)
            rows.append((dt.date(2024, 1, 1 + d), 1e9 + x if d else 5.0,
                         1e9 + 0.5 * x + rng.gauss(0, 1e-3)))
    rows += [(dt.date(2024, 2, 1), 1.0, 2.0), (dt.date(2024, 2, 2), None, 2.0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn(
        "part", F.pmod(F.monotonically_increasing_id(), F.lit(7))).cache()
    parts = [m.moments(df.where(F.col("part") == k)) for k in range(7)]
    left, right = parts[0], parts[3]
    for p in parts[1:3]:
        left = m.merge_moments(left.unionByName(p))
    for p in parts[4:]:
        right = right.unionByName(p)
    got = {r["execution_date"]: r for r in m.correlation_of(m.merge_moments(
        left.unionByName(right.select(*left.columns)))).collect()}
    assert sorted(r.day for r in got) == [1, 1, 2, 3, 4]
    for d in range(4):
        x, y = np.array([r[1:] for r in rows if r[0] == dt.date(2024, 1, 1 + d)]).T
        r = got[dt.date(2024, 1, 1 + d)]
        assert r["record_count"] == 400
        if d == 0:  # one side never moves
            assert r["correlation_1m"] is None and r["stddev_base_return"] == 0
            continue
        assert abs(r["correlation_1m"] - np.corrcoef(x - 1e9, y - 1e9)[0, 1]) < 1e-9
        assert abs(r["stddev_base_return"] - (x - 1e9).std(ddof=1)) < 1e-9
    single = got[dt.date(2024, 2, 1)]
    assert single["record_count"] == 1 and single["correlation_1m"] is None


def test_states_of_replayed_batches_count_once(spark):
    import datetime as dt
    root = scratch_path(spark, "moments")
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(day, float(i % 7), float(i % 5)) for i in range(60)], SCHEMA) \
        .withColumn("k", F.pmod(F.monotonically_increasing_id(), F.lit(5)))
    for batch in (0, 1, 1, 2, 3, 3, 4):
        m.add_moments(df.where(F.col("k") == batch), root, batch)
    schema = m.state_schema(df)
    (r,) = m.stored_correlation(spark, root, schema).collect()
    (want,) = m.correlation_of(m.moments(df)).collect()
    assert r["record_count"] == want["record_count"] == 60
    assert all(abs(x - y) < 2e-9 for x, y in zip(r[2:], want[2:]))
