"""What is made of tokens by unit is made where its unit was dealt to, in as many tasks as the text asks for."""

from parlance.operators import formats
from parlance.plans import speech


def test_tokens_stay_where_their_unit_is(spark):
    df = speech.verts(spark, "/root/testdata/sf0.001")
    for got in (formats.conllu(df, speech.K), formats.rebuilt(df, speech.K)):
        moves = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x]
        assert sum("REPARTITION_BY_NUM" in x for x in moves) == 1 and not any("ENSURE_REQUIREMENTS" in x and "turn" in x for x in moves)
        assert len(moves) == 2  # the other is that of the times, by conversation
    units = speech.spoken(spark, "/root/testdata/sf0.001")
    assert speech.dealt(units, 30 * speech.CHARACTERS - 1).rdd.getNumPartitions() == 30
