"""Shares are rounded by their binary values."""

from parlance.functions.fields import fixed
from parlance.operators.formats import turns_timeline
from pyspark.sql import functions as F


def test_decimals_of_binary_values(spark):
    xs = [0.1234565, 0.0000005, 0.0078125, 0.0234375, 0.4999995, 1.0, 0.0, 1 / 3, -0.0625015, 12345.6789012] + [(2 * k + 1) / 2e6 for k in range(0, 400_000, 977)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fixed(F.col("x"), 6).alias("six"), fixed(F.col("x"), 3).alias("three")).collect()
    assert [(r.six, r.three) for r in rows] == [(f"{r.x:.6f}", f"{r.x:.3f}") for r in rows] and len(rows) == len(xs)


def test_shares_of_turns(spark):
    units = spark.createDataFrame([("t", 0, "a", 0, 1), ("t", 1, "b", 3, 128)], "transcript_id string, tu_id long, speaker string, start long, end long")
    got = {r.tu_id: (r.left, r.width) for r in turns_timeline(units).collect()}
    assert got == {0: ("0.000000", "0.007812"), 1: ("0.023438", "0.976562")}
