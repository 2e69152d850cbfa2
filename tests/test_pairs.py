"""Pairs of transcriptions are cut by time, not by number of tokens."""

from parlance import cli
from parlance.operators import alignment

from .test_cli import lines


def test_left_out_words_dont_cut_the_other_side(spark, tmp_path):
    head = "token_id\tspeaker\ttu_id\tid\tspan\tform\talign\n"
    first = [(0, "a", "Begin=0.0"), (0, "b", "_"), (0, "c", "End=1.0"), (1, "d", "Begin=1.0"), (1, "e", "End=2.0"), (2, "f", "Begin=2.0|End=3.0")]
    for name, words in (("1_x", first), ("2_x", [first[0], first[2], *first[3:5]])):
        (tmp_path / f"{name}.vert.tsv").write_text(head + "".join(f"{u}-{k}\tA\t{u}\t{k}\t{w}\t{w}\t{t}\n" for k, (u, w, t) in enumerate(words)), encoding="utf-8")
    cli.main(["align", str(tmp_path / "*.vert.tsv"), str(tmp_path / "out")])
    got = [x.split("\t") for x in lines(tmp_path / "out/tokens")]
    a, b = got[0].index("a"), got[0].index("b")
    assert [(r[a], r[b]) for r in got[1:]] == [("a", "a"), ("b", "_"), ("c", "c"), ("d", "d"), ("e", "e")]


def test_pairs_without_times_are_whole(spark):
    files = spark.createDataFrame([("1_x", ["a", "b", "c"]), ("2_x", ["a", "c"])], "path string, tokens array<string>")
    r = alignment.file_pairs(files).first()
    assert (r.a, r.b, r.timed) == (["a", "b", "c"], ["a", "c"], False)
