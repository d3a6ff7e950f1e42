"""Rounding to four places against Python's own."""

import math
import random

from pyspark.sql import functions as F

from scriptorium.functions.rounding import round_4
from scriptorium.operators.report import perplexity


def numbers():
    rng = random.Random(5)
    found = [0.0, 0.5, 5e-324, 1.7e308, 2.0**38, 2.0**39, 2.0**39 - 2.0**-14, 0.00005, 0.00015, 1.00005, 2.5]
    # exact halves of a ten-thousandth: multiples of 1/32 have five places
    found += [n / 32 for n in range(200)] + [2.0**k + n / 32 for k in range(1, 40) for n in range(33)]
    found += [rng.uniform(0, 10.0**k) for k in range(-5, 14) for _ in range(2_500)]
    found += [math.exp(rng.uniform(0, 30)) for _ in range(50_000)]
    # next to a half, on either side
    halves = [rng.randrange(10**9) / 10_000 + 0.00005 for _ in range(3_000)]
    return found + halves + [math.nextafter(h, s) for h in halves for s in (0.0, math.inf)]


def test_numbers_are_rounded_as_python_does(spark):
    values = numbers()
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", round_4(F.col("x")).alias("r"))
    assert len(values) > 100_000
    assert [(r.x, r.r) for r in rows.collect() if r.r != round(r.x, 4)] == []


def test_perplexity_of_many_losses(spark):
    rng = random.Random(6)
    losses = [rng.uniform(0, 40) for _ in range(2_000)] + [0.0, 709.7, 709.8, None, float("inf"), -3.0]
    rows = spark.createDataFrame([(v,) for v in losses], "l double")
    for r in rows.select("l", F.exp("l").alias("e"), perplexity(F.col("l")).alias("p")).collect():
        if r.l is None or r.l == 709.8:
            assert r.p is None
        else:
            assert r.p == (r.l if math.isinf(r.l) else round(r.e, 4))
