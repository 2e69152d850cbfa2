"""Names, line ends, absent files, dictionaries with repeated values, ids of aligned tokens."""

import pytest

from parlance.operators import alignment, metadata
from parlance.sources import config, files


def test_names_with_blanks_and_marks(spark, tmp_path):
    for name in ("con spazio è", "a+b%20c"):
        (tmp_path / f"{name}.vert.tsv").write_text("token_id\tspan\n1-0\tx\n", encoding="utf-8")
    got = {r.transcript_id for r in files.read_vert(spark, str(tmp_path / "*.vert.tsv")).collect()}
    assert got == {"con spazio è", "a+b%20c"}


def test_absent_and_globbed_metadata(spark, tmp_path):
    assert files.read_metadata(spark, str(tmp_path / "none.tsv")).count() == 0
    (tmp_path / "m.tsv").write_text("code\tgender\nA\tF\n", encoding="utf-8")
    for path in (str(tmp_path / "*.tsv"), f"file://{tmp_path}/m.tsv"):
        assert [r.code for r in files.read_metadata(spark, path).collect()] == ["A"]
    with pytest.raises(FileNotFoundError):
        config.load(tmp_path / "mistyped.yml")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_conllu_line_ends(spark, tmp_path, end):
    row = lambda k, w: "\t".join([str(k), w, *["_"] * 8])
    lines = ["# sent_id = s_1", "# text = a b", row(1, "a"), row(2, "b"), "", "# sent_id = s_2", row(1, "c"), "", ""]
    (tmp_path / "x.conllu").write_bytes(end.join(lines).encode())
    got = files.read_conllu(spark, str(tmp_path / "x.conllu")).orderBy("sent", "idx").collect()
    assert [(r.sent_id, r.id, r.form, r.misc) for r in got] == [("s_1", "1", "a", "_"), ("s_1", "2", "b", "_"), ("s_2", "1", "c", "_")] and got[0].text == "a b"


def test_last_of_several_translations(spark):
    words = spark.createDataFrame([("t", "c", "x", "first", 1), ("t", "c", "x", "last", 2), ("t", "c", None, "n", 3)], "table string, column string, en string, it string, line int")
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    assert {r.c for r in metadata.translated(df, words, "t", ["c"]).collect()} == {"last", "y", None}


def test_ids_and_distance_of_an_alignment(spark):
    pairs = spark.createDataFrame([(1, ["a", "b", "c", "d"], ["a", "x", "d"], ["1", "2", "3", "4"], ["5", "6", "7"]), (2, ["a"], ["a"], ["1"], ["1"])], "k int, a array<string>, b array<string>, i array<string>, j array<string>")
    rows = alignment.alignment_rows(pairs, ["k"], ids=("i", "j"))
    got = [tuple(r) for r in rows.where("k = 1").orderBy("position").select("a", "b", "id_a", "id_b").collect()]
    assert got[0] == ("a", "a", "1", "5") and got[-1] == ("d", "d", "4", "7") and sorted((a, x) for a, _, x, _ in got) == [("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")]
    assert [x for _, b, _, x in got if b == "_"] == ["_"] and {x for _, b, _, x in got if b == "x"} == {"6"}
    rates = {r.k: r for r in alignment.error_rate(rows, ["k"]).collect()}
    assert rates[2].distance == 0 and rates[1].distance == (1 + 0.5) / 4
