"""The paired moving-block bootstrap against a plain loop."""

import datetime as dt
import hashlib
import random
from decimal import Decimal

import numpy as np

from barflow.operators import promotion


def brute(gains, block, replicates, seed):
    n, size, means = len(gains), min(block, len(gains)), []
    for rep in range(replicates):
        taken = []
        for no in range(-(-n // size)):
            first = int(hashlib.md5(f"{seed}:{rep}:{no}".encode()).hexdigest()[:15], 16) % (n - size + 1)
            taken += gains[first:first + size]
        means.append(float(sum(taken[:n])) / n)
    return float(np.quantile(means, 0.1)), sum(m <= 0 for m in means) / replicates


def test_bootstrap_equals_a_plain_loop(spark):
    rng, t0, rows, want = random.Random(2), dt.datetime(2024, 1, 1), [], {}
    for key, n, drift in (("a", 47, 1.0), (None, 33, -0.2), ("short", 3, 0.5), ("one", 1, 0.0)):
        gains = []
        for i in range(n):
            old, new = (Decimal(str(round(rng.gauss(m, 2), 2))) for m in (0, drift))
            hole = i % 10 == 9
            rows.append((key, t0 + dt.timedelta(hours=i), float(old), None if hole else float(new)))
            if not hole:
                gains.append(new - old)
        want[key] = (len(gains), float(sum(gains)) / len(gains), *brute(gains, 5, 60, 7))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t timestamp, old double, new double")
    got = {r.k: r for r in promotion.paired_block_bootstrap(df, ["k"], ["t"], "old", "new", 5, 60, 7, 0.9).collect()}
    assert set(got) == set(want)
    for key, (n, mean, lower, p) in want.items():
        r = got[key]
        assert r.n == n and abs(r.mean_gain - mean) < 1e-9 and abs(r.lower - lower) < 1e-9 and abs(r.p_value - p) < 1e-9
        assert r.promote == (lower > 0)
    assert promotion.paired_block_bootstrap(df.limit(0), ["k"], ["t"], "old", "new").count() == 0
