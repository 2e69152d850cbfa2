"""Tokens are made in their unit's row: none is moved to find its place, its neighbours or its spans."""

from parlance.operators import tokens as T
from parlance.operators.units import prepare
from parlance.sources.work import written


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def units(spark):
    text = "[ciao (.) l'albero=po': [{P} xx] °ma° (so)le ((ride)) A:h, " * 40
    rows = [("t", i, "a", 2.0 * i, 2.0 * i + 2.5, x) for i, x in enumerate([text, "# (ci)ao [sì], <no> (.)", "", "#_ hi (.)", "°uno° (.)(.) [due]"])]
    return spark.createDataFrame(rows, "transcript_id string, tu_id long, speaker string, start double, end double, text string")


def test_offsets_without_a_shuffle(spark):
    df = units(spark).selectExpr("*", "'none' as variation", "true as include")
    got = T.tokenize(df)
    assert "Exchange" not in plan(got) and "Window" not in plan(got)
    by = {}
    for r in got.collect():
        assert r.text[r.s : r.e] == r.span
        by.setdefault(r.tu_id, []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: r.idx)
        assert [r.idx for r in rows] == list(range(len(rows))) and {r.n_tokens for r in rows} == {len(rows)}
        assert [r.pause_after for r in rows] == [n.type == "shortpause" for n in rows[1:]] + [False]
    assert max(map(len, by.values())) > 400


def test_marks_are_the_spans(spark):
    ready = written(prepare(units(spark)), "ready")
    joined = T.with_spans(T.tokenize(ready), ready, ["sole"])
    marked = T.with_marks(T.tokenize(ready.join(T.unit_marks(ready, ["sole"]), ["transcript_id", "tu_id"], "left"), keep=[*T.UNIT_COLUMNS, "marks"]))
    rows = lambda df: sorted(map(repr, df.select("tu_id", "idx", "span", "slow", "fast", "guesses", "overlaps", "reduced", "volume").collect()))
    assert rows(marked) == rows(joined) and any("guesses='" in r for r in rows(marked))
