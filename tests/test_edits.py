"""Patches from edited tables, and tables from CoNLL-U."""

import glob
import re

from parlance import cli
from parlance.operators import patching, wip
from pyspark.sql import functions as F

HEAD = "token_id\tspeaker\ttu_id\tspan\tform\ttype\tjefferson_feats\talign\tpace"
OLD = [
    "0-0\tA\t0\t°sì.°\tsì\tlinguistic\tIntonation=Falling|Volume=Low\tBegin=1.0|End=1.5\t_",
    "1-0\tA\t1\tcasaa\tcasaa\tlinguistic\tProsodicLink=Yes\tBegin=2.0\t_",
    "1-1\tA\t1\tdi\tdi\tlinguistic\t_\t_\t_",
    "1-2\tA\t1\tlui\tlui\tlinguistic\t_\tEnd=3.0\tSlow=1",
    "2-0\tB\t2\tBEH?\tbeh\tlinguistic\tVolume=High|Intonation=Rising\tBegin=4.0|End=5.0\t_",
    "3-0\tB\t3\t(.)\t[PAUSE]\tshortpause\t_\t_\t_",
]
NEW = ["0-0,0,A,°sì.°,sì,_", "1-0,_,_,casa,casa,Lang=ita", "1-1,1,A,di,di,_", "1-1a,1,A,d,d,_", "2-0,2,B,BEH?,bah,_", "2-1,2,_,no,no,_", "3-0,3,B,(.),[PAUSE],_"]


def applied(patch, lines):
    """The lines of a file after a unified difference; what it takes away must be there."""
    out, at = [], 0
    for row in patch.splitlines(keepends=True)[2:]:
        hunk = re.match(r"@@ -(\d+)(?:,(\d+))? ", row)
        if hunk:
            start = int(hunk[1]) - (hunk[2] != "0")
            out += lines[at:start]
            at = start
        elif row[0] == "+":
            out.append(row[1:])
        else:
            assert lines[at] == row[1:]
            out += [row[1:]] if row[0] == " " else []
            at += 1
    return out + lines[at:]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def test_patch_makes_the_edited_file(spark, tmp_path):
    old = [f"{line}\r\n" for line in [HEAD, *OLD]]
    write(tmp_path / "in/X1.vert.tsv", "".join(old))
    write(tmp_path / "in/X2.vert.tsv", "".join(old))
    write(tmp_path / "ed/X1.csv", "\n".join(["token_id,tu_id,speaker,span,form,jefferson_feats", *NEW]) + "\n")
    same = [",".join([c[0], c[2], c[1], c[3], c[4], "_"]) for c in (line.split("\t") for line in OLD)]
    write(tmp_path / "ed/X2.csv", "\n".join(["token_id,tu_id,speaker,span,form,jefferson_feats", *same]) + "\n")
    read = cli.files.read_table
    spark_table = lambda s, path, sep="\t": read(s, path, "," if "/ed/" in path else sep)
    cli.files.read_table = spark_table
    try:
        args = type("A", (), {"verb": "make_patch", "input": f"{tmp_path}/in/*.tsv", "output": f"{tmp_path}/out", "edited": f"{tmp_path}/ed/*.csv", "config": None, "threshold": None})
        cli.run(spark, args)
    finally:
        cli.files.read_table = read
    assert not glob.glob(f"{tmp_path}/out/patches/*X2*") and not glob.glob(f"{tmp_path}/out/recaps/*X2*")
    text = lambda kind: open(glob.glob(f"{tmp_path}/out/{kind}/*X1*/part*")[0], newline="").read()
    got = [line.rstrip("\r\n").split("\t") for line in applied(text("patches"), old)]
    assert got[0] == HEAD.split("\t") and [r[0] for r in got[1:]] == ["0-0", "1-0", "1-1", "2-0", "2-1", "3-0"]
    rows = {r[0]: dict(zip(got[0], r, strict=True)) for r in got[1:]}
    assert rows["1-0"]["span"] == "casa" and rows["1-0"]["jefferson_feats"] == "ProsodicLink=Yes|Lang=ita" and rows["1-0"]["align"] == "Begin=2.0"
    assert rows["1-1"]["align"] == "End=3.0", "the time of the dropped token goes to the one before"
    assert rows["2-0"]["align"] == "Begin=4.0" and rows["2-1"]["align"] == "End=5.0" and rows["2-1"]["speaker"] == "B" and rows["2-1"]["type"] == "linguistic"
    assert all(line.endswith("\r\n") for line in applied(text("patches"), old))
    recap = text("recaps")
    assert "| modifiche | 2 |" in recap and "| eliminazioni | 1 |" in recap and "| aggiunte | 1 |" in recap
    assert "✅ End=3.0 → `1-1`" in recap and "⚠️ pace=`Slow=1`" in recap and "forma non derivabile" in recap and "✅ End=5.0 ← `2-0`" in recap


def tables(spark, old, new):
    cols = ["token_id", "tu_id", "speaker", "span", "form", "align"]
    source = spark.createDataFrame([("f", i, cols, dict(zip(cols, r, strict=True))) for i, r in enumerate(old, 1)], "file string, line int, cols array<string>, cells map<string,string>")
    heads = spark.createDataFrame([("f", cols, "\n", "h\n")], "file string, cols array<string>, eol string, head string")
    return source, heads, spark.createDataFrame([("f", i, *r) for i, r in enumerate(new)], "file string, line int, token_id string, tu_id string, speaker string, span string, form string")


def test_times_and_neighbours_of_dropped_and_added_tokens(spark):
    old = [
        ("1-0", "1", "A", "a", "a", "End=1"), ("1-1", "1", "A", "b", "b", "Begin=2|End=2"), ("1-2", "1", "A", "b", "b", "Begin=3|End=3"), ("2-0", "_", "_", "c", "c", "Begin=4|X=1"),
        ("2-1", "_", "_", "c", "c", "_"), ("3-0", "3", "B", "d", "d", "_"), ("3-1", "3", "B", "d", "d", "Begin=9"),
    ]
    new = [("1-0", "1", "A", "a", "a"), ("2-0", "_", "_", "c", "c"), ("2-1", "_", "_", "c", "c"), ("9-0", "_", "_", "n", "n"), ("9-1", "_", "_", "n", "n"), ("9-2", "3", "_", "n", "n"), ("3-0", "3", "B", "d", "d")]
    rows = patching.patched(*tables(spark, old, new)).collect()
    got = {r.token_id: r for r in rows}
    assert got["1-1"].notes == ["❌ End conflict: End=2 but `1-0` already has End=1"]
    assert got["1-2"].notes == ["❌ End conflict: End=3 but `1-0` already has End=1", "❌ Begin conflict: pending Begin=2 overwritten by Begin=3", "❌ Begin=3 conflict: `2-0` already has Begin=4"]
    assert got["3-1"].notes == [] and got["2-0"].new["align"] == "Begin=4|X=1"
    assert (got["2-0"].new["tu_id"], got["2-1"].new["tu_id"], got["2-1"].new["speaker"]) == ("1", "_", "_"), "the last of a run agrees with neither side"
    assert [got[k].new["tu_id"] for k in ("9-0", "9-1", "9-2")] == ["3", "3", "3"] and [got[k].new["speaker"] for k in ("9-0", "9-2")] == ["B", "B"]
    assert patching.patched(*(t.limit(0) for t in tables(spark, old, new))).count() == 0


def test_recap_of_moved_tokens(spark):
    old = [(f"{i}-0", "1", "A", "a", "a", "_") for i in range(5)]
    new = [(f"{i}-0", "1", "A", "b", "b") for i in (0, 3, 4, 1, 7)]
    items = patching.recap_items(patching.patched(*tables(spark, old, new))).orderBy("at").collect()
    assert [(r.token_id, r.change) for r in items] == [("0-0", "changed"), ("2-0", "dropped"), ("3-0", "changed"), ("4-0", "changed"), ("7-0", "added")], "1-0 moved, and isn't listed"


CONLLU = """# sent_id = 7_a
# text = x
# jefferson_text = [Cia::o]. mah c'era xx (0.5) dirlo la
# speaker_id = S1
1\tciao\tciao\tINTJ\t_\t_\t0\troot\t_\t_
2\tc'\tci\tPRON\t_\t_\t1\tdep\t_\tKID=7-4
3\tera\tessere\tVERB\t_\t_\t1\tdep\t_\t_
4\tx\tx\tX\t_\t_\t1\tdep\t_\tPauseAfter=Yes
5\t(.)\t_\tX\t_\t_\t1\tdep\t_\t_
6-7\tdirlo\t_\t_\t_\t_\t_\t_\t_\t_
6\tdir\tdire\tVERB\t_\t_\t1\tdep\t_\tKID=7-8
7\tlo\tlo\tPRON\t_\t_\t1\tdep\t_\tKID=7-8
8\tde\tdi\tADP\t_\t_\t1\tdep\t_\tKID=7-9a
9\tl\til\tDET\t_\t_\t1\tdep\t_\tKID=7-9b

"""


def test_conllu_to_wip(spark, tmp_path):
    write(tmp_path / "BOA1.conllu", CONLLU)
    rows = wip.converted(cli.files.read_conllu(spark, f"{tmp_path}/*.conllu").withColumnRenamed("transcript_id", "file")).orderBy("sort").collect()
    assert [(r.token_id, r.id, r.span, r.form, r.tu_id, r.lemma) for r in rows] == [
        ("7-0", "1", "[Cia::o].", "ciao", "7", "ciao"), ("7-4", "2", "c'", "c'", "7", "ci"), ("7-5", "3", "era", "era", "7", "essere"), ("7-6", "4", "xx", "x", "7", "x"), ("7-7", "_", "(0.5)", "[PAUSE]", "7", "[PAUSE]"),
        ("7-8", "6-7", "dirlo", "dirlo", "7", "_"), ("7-8a", "6", "_", "dir", "_", "dire"), ("7-8b", "7", "_", "lo", "_", "lo"), ("7-9", "8-9", "la", "la", "7", "_"), ("7-9a", "8", "_", "de", "_", "di"), ("7-9b", "9", "_", "l", "_", "il"),
    ]
    assert {r.token_id: r.note for r in rows if r.note} == {"7-4": "word passed over: mah", "7-8": "letters of parts made up", "7-9": "parent made up"}
    cli.run(spark, type("A", (), {"verb": "conllu2wip", "input": f"{tmp_path}/*.conllu", "output": f"{tmp_path}/out", "config": None, "threshold": None}))
    lines = open(glob.glob(f"{tmp_path}/out/wip/*BOA1/part*")[0]).read().splitlines()
    assert lines[0] == ",".join(wip.FIELDS) and len(lines) == 12 and lines[1].startswith("7-0,S1,7,7,1,[Cia::o].,ciao")
    assert spark.read.csv(f"{tmp_path}/out/notes", sep="\t", header=True).where(F.col("note") == "parent made up").count() == 1


def test_validate_names_files_without_rows(spark, tmp_path):
    write(tmp_path / "in/a.vert.tsv", "token_id\tspan\tform\tlemma\tupos\n0-0\tx\tx\tx\tV\n")
    write(tmp_path / "in/b.vert.tsv", "token_id\tspan\tform\tlemma\tupos\n")
    write(tmp_path / "in/c.vert.tsv", "")
    args = type("A", (), {"verb": "validate", "input": f"{tmp_path}/in/*.tsv", "output": f"{tmp_path}/out", "config": None, "threshold": None})
    assert cli.run(spark, args) == 3
    read = lambda name: "".join(open(p).read() for p in glob.glob(f"{tmp_path}/out/transcript_id={name}/part*"))
    assert "unknown upos" in read("a") and "no rows" not in read("a") and "no rows" in read("b") and "no rows" in read("c")
