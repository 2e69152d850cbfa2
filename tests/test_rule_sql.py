"""The SQL of accents, inner spaces and the whole chain against the rules, on texts that need them."""

import duckdb
import pytest

import __spark_entry__

TEXTS = [
    "perchè pò pò pero' perche' puo' nè", "affin:chè (per)chè= nèro po' però", "° piano° <ride > >va < ((un po' di)) 21 anni", "CIAO Élite ÀÈ a(b)c(d)e (forse) [sì] 108",
    "xperchè dopodichèx perchè' p(e)rò'", "(.) [ ] ° ° <> mha he m =m=", "",
]


@pytest.mark.parametrize("name", ["norm_accents", "norm_inner_spaces", "norm_full", "units_prepared"])
def test_sql_agrees(spark, tmp_path, name):
    rows = [(c, t, "u", text) for c, text in enumerate(TEXTS) for t in range(10)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = __spark_entry__.queries()[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    right = con.execute(f"select {', '.join(got.columns)} from ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(right)
