"""Modules of a corpus, their metadata verbs, and turns found by a cursor."""

import pytest

from parlance import cli
from parlance.operators import alignment
from parlance.operators.units import total_length
from parlance.sources import files, modules

from .test_cli import lines


@pytest.fixture()
def corpus(tmp_path):
    for name, participants in (("one", "A;B"), ("two", "C")):
        m = tmp_path / "corpus" / name
        (m / "metadata").mkdir(parents=True)
        (m / "tsv").mkdir()
        (m / "metadata/conversations.tsv").write_text(f"code\ttype\tparticipants\nX{name}\tfree:meal\t{participants}\nshared\tfree\t\n", encoding="utf-8")
        (m / "metadata/participants.tsv").write_text("code\tconversations\tschool-region\n" + "".join(f"{p}\tX{name}\tlazio:rieti\n" for p in participants.split(";")), encoding="utf-8")
        (m / f"tsv/X{name}.vert.tsv").write_text("token_id\t speaker\n" + "".join(f"0-{k}\t{p}\n" for k, p in enumerate([*participants.split(";"), "??"] if name == "one" else ["D"])), encoding="utf-8")
    (tmp_path / "corpus/.hidden/metadata").mkdir(parents=True)
    (tmp_path / "corpus/empty").mkdir()
    return tmp_path / "corpus"


def test_discovery(spark, corpus):
    names = lambda **how: [p.rsplit("/", 1)[-1] for p in modules.discovered(spark, str(corpus), **how)]
    assert names() == ["one", "two"] and names(skip=("one",)) == ["two"]
    assert modules.listed(spark, f"{corpus}/two, {corpus}/one") == [f"{corpus}/two", f"{corpus}/one"]


def test_merging(spark, corpus, tmp_path):
    cli.main(["merge_metadata", str(corpus), str(tmp_path / "all")])
    people = (tmp_path / "all/participants.tsv").read_text(encoding="utf-8").splitlines()
    assert people[0].split("\t")[:5] == ["code", "occupation", "gender", "conversations", "birth-region"]
    assert people[1].split("\t") == ["A", "", "", "Xone", "lazio", "", ""] and len(people) == 4
    talks = (tmp_path / "all/conversations.tsv").read_text(encoding="utf-8").splitlines()
    assert [x.split("\t")[:2] for x in talks[1:]] == [["Xone", "free"], ["Xtwo", "free"], ["shared", "free"]]


def test_translating(spark, corpus, tmp_path):
    (tmp_path / "words.tsv").write_text("table\tcolumn\ten\tit\nconversations\ttype\tfree\tlibera\nconversations\tabsent\tx\ty\n", encoding="utf-8")
    cli.main(["translate_metadata", str(corpus / "one/metadata"), str(tmp_path / "it"), "--translations", str(tmp_path / "words.tsv")])
    assert [x.split("\t")[1] for x in (tmp_path / "it/conversations.tsv").read_text(encoding="utf-8").splitlines()] == ["type", "libera:meal", "libera"]
    assert (tmp_path / "it/conversations.untranslated.tsv").read_text(encoding="utf-8").splitlines() == ["column\tvalue"]


def test_checks_and_their_number(spark, corpus, tmp_path):
    got = cli.main(["check_participants", str(corpus), str(tmp_path / "out")])
    one = (tmp_path / "out/one.tsv").read_text(encoding="utf-8").splitlines()[1:]
    two = {tuple(x.split("\t")) for x in (tmp_path / "out/two.tsv").read_text(encoding="utf-8").splitlines()[1:]}
    assert one == ["shared\t_\tno transcript"] and got == len(one) + len(two)
    assert two == {("shared", "_", "no transcript"), ("Xtwo", "C", "does not speak"), ("Xtwo", "D", "speaks but is not listed"), ("_", "D", "speaker without a row")}


def test_unknown_participants_in_place(spark, corpus):
    for _ in range(2):
        cli.main(["unknown_participants", f"{corpus}/one,{corpus}/two", "-"])
    assert (corpus / "one/metadata/conversations.tsv").read_text(encoding="utf-8") == "code\ttype\tparticipants\tunknown-participant\nXone\tfree:meal\tA;B\tyes\nshared\tfree\t\t_\n"
    assert (corpus / "two/metadata/conversations.tsv").read_text(encoding="utf-8").splitlines()[1] == "Xtwo\tfree:meal\tC\tno"
    assert sorted(p.name for p in (corpus / "one/metadata").iterdir() if not p.name.startswith(".")) == ["conversations.tsv", "participants.tsv"]


def test_a_conversation_and_its_people(spark, corpus):
    own, people = modules.of_conversation(spark, str(corpus / "one"), "Xone")
    assert own.first().participants == "A;B" and {r.code for r in people.collect()} == {"A", "B"}
    own, people = modules.of_conversation(spark, str(corpus / "one"), "none")
    assert own.isEmpty() and people.count() == 2
    assert modules.headers(spark, str(corpus / "one/metadata/participants.tsv")) == ["code", "conversations", "school-region"]


def test_summaries(spark, tmp_path):
    path = tmp_path / "summary.json"
    assert modules.summary(spark, str(path)) is None
    path.write_text('[{"transcript": "a", "n": 1}, {"transcript": "b", "n": 2}, {"transcript": "a", "n": 3}]', encoding="utf-8")
    assert {(r.transcript, r.n) for r in modules.summary(spark, str(path)).collect()} == {("a", 3), ("b", 2)}


def test_paths(spark, tmp_path):
    assert modules.patch_path("/c/forest/wip/M/a1.csv") == "/c/forest/patches/M/a1.vert.tsv.patch"
    assert modules.patch_path("/c/a1.csv") == "/c/a1.vert.tsv.patch"
    assert modules.source_path("/c/forest/wip/M/a1.csv") == "/c/M/tsv/a1.vert.tsv"
    assert modules.source_path("wip/M/a1.csv", "/x") == "/x/M/tsv/a1.vert.tsv"
    with pytest.raises(ValueError):
        modules.source_path("/c/a1.csv")
    urls = spark.range(1).select(*modules.file_urls(*[modules.F.lit(x) for x in ("M", "a1")], "https://example.org/c/")).first()
    assert tuple(urls) == ("https://example.org/c/M/blob/dev/tsv/a1.vert.tsv", "https://example.org/c/M/blob/dev/eaf/a1.eaf")
    (tmp_path / "e.csv").write_text("token_id,span\n", encoding="utf-8")
    assert modules.is_file(spark, str(tmp_path / "e.csv")) and modules.is_folder(spark, str(tmp_path)) and not modules.is_file(spark, str(tmp_path / "none"))
    assert modules.readable(spark, str(tmp_path / "e.csv")) == "the file is empty or has no rows" and modules.readable(spark, str(tmp_path / "none")) == "the file can't be read"


def test_turns_by_cursor(spark):
    def found(turns, units):
        t = spark.createDataFrame([("t", k, *x) for k, x in enumerate(turns)], "transcript_id string, turn int, speaker string, text string")
        u = spark.createDataFrame([("t", k, *x) for k, x in enumerate(units)], "transcript_id string, tu_id int, speaker string, text string")
        return [r.tu_id for r in alignment.turns_by_cursor(t, u).orderBy("turn").collect()]

    a, b, c = ("A", "sì"), ("B", "no"), ("A", "poi")
    # the second "sì" was left out of the units, so the third finds the place behind b
    assert found([a, b, a], [a, b, a]) == [0, 1, 2]
    assert found([c, a, a], [a, c, a]) == [1, 2, 0]
    assert found([c, a], [a, b, ("A", ""), c]) == [2 + 1, 0]
    # more than three places back is too far; a turn without a unit moves nothing on
    assert found([c, a, c], [a, b, b, b, c]) == [4, None, 4]
    assert found([(None, "sì"), ("A ", " sì ")], [a]) == [None, 0]


def test_alignment_has_ids(spark, tmp_path):
    for name, words in (("1_x", ["a", "b", "c"]), ("2_x", ["a", "c"])):
        (tmp_path / f"{name}.vert.tsv").write_text("token_id\tspeaker\ttu_id\tid\tspan\tform\talign\n" + "".join(f"0-{k}\tA\t0\t{k}\t{w}\t{w}\t{'Begin=0.0|End=1.0'}\n" for k, w in enumerate(words)), encoding="utf-8")
    cli.main(["align", str(tmp_path / "*.vert.tsv"), str(tmp_path / "out")])
    got = [x.split("\t")[3:] for x in lines(tmp_path / "out/aligned")]
    assert got == [["match", "id_A", "token_A", "id_B", "token_B"], ["0", "0-0", "a", "0-0", "a"], ["1", "0-1", "b", "_", "_"], ["0", "0-2", "c", "0-1", "c"]]


def test_annotations_and_translations(spark, tmp_path):
    (tmp_path / "t.csv").write_text("tu_id\tspeaker\tstart\tend\tduration\ttext\tparent_tu_id\n0\tA\t0.0\t2.0\t2.0\tciao [a tutti]\t\n1\tB\t1.0\t3.0\t2.0\t[e poi] no\t\n2\tA_trad\t0.0\t2.0\t2.0\thello\t0\n", encoding="utf-8")
    (tmp_path / "notes.yml").write_text("ignore:\n  - 0 1\n", encoding="utf-8")
    for extra in ([], ["--annotations", str(tmp_path / "notes.yml")]):
        cli.main(["process", str(tmp_path / "t.csv"), str(tmp_path / f"out{len(extra)}"), *extra])
    rows = [x.split("\t") for x in lines(tmp_path / "out0/translations")]
    assert rows[0] == ["tu_id", "speaker", "start", "end", "parent_tu_id", "text"] and rows[1][0] == "2" and rows[1][4:] == ["0", "hello"]
    assert lines(tmp_path / "out0/vert") != lines(tmp_path / "out2/vert")


def test_lengths(spark):
    units = spark.createDataFrame([("t", 0, 0.0, 9.0), ("t", 1, 5.0, 6.0), ("t", 2, 5.0, 7.0), ("u", 0, 1.0, 2.0)], "transcript_id string, tu_id int, start double, end double")
    assert {tuple(r) for r in total_length(units).collect()} == {("t", 7.0), ("u", 2.0)}


def test_lines_as_they_are(spark, tmp_path):
    (tmp_path / "a.vert.tsv").write_bytes("x\ty\r\nè\t1\r\n\r\nend".encode())
    (tmp_path / "b.vert.tsv").write_bytes(b"x\n")
    got = sorted(tuple(r) for r in files.read_lines(spark, str(tmp_path / "*.tsv")).collect())
    assert got == [("a", 0, "x\ty\r\n", "\r\n"), ("a", 1, "è\t1\r\n", "\r\n"), ("a", 2, "\r\n", "\r\n"), ("a", 3, "end", "\r\n"), ("b", 0, "x\n", "\n")]
