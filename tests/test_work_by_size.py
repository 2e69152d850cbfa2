import re

from pyspark.sql import functions as F

from parlance.operators import patches, patching, wip
from parlance.plans import edits, registry


def test_tokens_of_a_sentence_are_shuffled_once(spark):
    rows = [("F", k, i, f"{k}_x", "a b c", "S", str(i), w, w, "X", f"KID={k}-{i - 1}") for k in range(3) for i, w in enumerate("abc", 1)]
    df = wip.converted(spark.createDataFrame(rows, "file string, sent long, idx int, sent_id string, jefferson_text string, speaker_id string, id string, form string, lemma string, upos string, misc string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Join" not in plan
    assert sorted((r.token_id, r.span) for r in df.where("sort.sent = 1").collect()) == [("1-0", "a"), ("1-1", "b"), ("1-2", "c")]


def test_order_lines_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "ROWS", 10)
    spark.range(95).select((F.col("id") % 30).alias("l_orderkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert registry.lines(spark, str(tmp_path)).rdd.getNumPartitions() == 10
    assert edits.lines is registry.lines


def test_runs_are_the_same_in_stretches(spark):
    changes = ["kept", "kept", "changed", "dropped", "kept", "added", "kept"]
    rows = [(f, 10 * i + f, (i // 3) % 2, changes[(i * i + f) % 7]) for f in range(3) for i in range(60)]
    df = spark.createDataFrame(rows, "file long, line long, unit long, change string")
    whole = sorted(map(tuple, patches.recap(df, "line", "unit", "file").collect()))
    for tasks, bounds in ((1, None), (7, None), (60, None), (500, None), (7, (100, 200)), (7, (0, 0))):
        assert sorted(map(tuple, patches.recap(df, "line", "unit", "file", tasks, bounds).collect())) == whole
    cut = patches.recap(df, "line", "unit", "file", 7)
    assert cut.count() == len(whole) and {r.run for r in cut.collect()} == {r[1] for r in whole}


def test_patch_rows_are_the_same_in_more_tasks(spark, tmp_path):
    spark.range(400).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "substr('FOP', int(id % 3) + 1, 1) as o_orderstatus", "concat(id % 5, '-X') as o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    sides = edits.sides(spark, str(tmp_path))
    shown = ["file", "token_id", "change", "new", "notes"]
    rows = [sorted((str(r) for r in patching.patched(*sides, tasks=n).select(*shown).collect())) for n in (None, 1, 9)]
    assert rows[0] and rows[0] == rows[1] == rows[2]
