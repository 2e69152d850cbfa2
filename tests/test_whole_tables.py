"""The whole-job queries beside those whose SQL takes a part."""

import __spark_entry__
from parlance.operators import alignment, reports


def test_widened_to_the_longest(spark):
    df = spark.createDataFrame([(1, [5]), (2, [6, 7, 8, 9]), (3, None)], "k int, n array<int>")
    got = reports.widened(df, "n")
    assert got.columns == ["k", "n::0", "n::1", "n::2", "n::3"]
    assert sorted(map(tuple, got.collect())) == [(1, 5, 0, 0, 0), (2, 6, 7, 8, 9), (3, 0, 0, 0, 0)]


def test_whole_queries_lose_nothing(spark, tmp_path):
    orders = [(k, k % 3) for k in range(20)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    wide = {r.o_custkey: [int(x) for x in r.wide.split(",")] for r in __spark_entry__.queries()["stats_widened_whole"](spark, str(tmp_path)).collect()}
    assert wide == {0: [0, 3, 6, 9, 12, 15, 18], 1: [1, 4, 7, 10, 13, 16, 19], 2: [2, 5, 8, 11, 14, 17, 0]}
    turns = [(1, 0, "u", "same"), (1, 1, "u", "some"), (1, 2, "u", "such"), (1, 3, "u", "same"), (1, 4, "u", "same")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.turn: r.tu_id for r in __spark_entry__.queries()["turn_unit_align_whole"](spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: None, 2: 2, 3: 3, 4: 4}


def test_ties_go_in_order(spark):
    df = spark.createDataFrame([("t", k, "A", "x") for k in range(3)], "transcript_id string, turn int, speaker string, text string")
    got = alignment.turns_to_units(df, df.where("turn > 0").withColumnRenamed("turn", "tu_id"))
    assert sorted((r.turn, r.tu_id) for r in got.collect() if r.tu_id) == [(0, 1), (1, 2)]
