from parlance import cli


def test_from_eaf_to_texts(spark, tmp_path):
    (tmp_path / "t.csv").write_text("tu_id\tspeaker\tstart\tend\tduration\ttext\n0\tA\t0.0\t1.0\t1.0\tciao\n1\tB\t1.5\t2.0\t0.5\tsì\n", encoding="utf-8")
    cli.main(["csv2eaf", str(tmp_path / "t.csv"), str(tmp_path / "eaf")])
    text = "\n".join(p.read_text(encoding="utf-8") for p in (tmp_path / "eaf/transcript_id=t").glob("part-*"))
    assert 'TIME_VALUE="1500"' in text and "<ANNOTATION_VALUE>ciao</ANNOTATION_VALUE>" in text
    (tmp_path / "t.eaf").write_text(text, encoding="utf-8")
    cli.main(["eaf2csv", str(tmp_path / "t.eaf"), str(tmp_path / "csv")])
    lines = [x for p in (tmp_path / "csv/transcript_id=t").glob("part-*") for x in p.read_text(encoding="utf-8").splitlines()]
    assert len(lines) == 3 and lines[1].startswith("0\tA\t0.0\t1.0")


def lines(path):
    return [x for p in sorted(path.rglob("part-*")) if not p.name.startswith(".") for x in p.read_text(encoding="utf-8").splitlines()]


def test_pairs_of_transcriptions(spark, tmp_path):
    head = "token_id\tspeaker\ttu_id\tid\tspan\tform\tlemma\tupos\n"
    for name, words in (("1_x", ["ciao", "bello", "no"]), ("2_x", ["ciao", "bella", "no", "più"])):
        (tmp_path / f"{name}.vert.tsv").write_text(head + "".join(f"0-{k}\tA\t0\t{k}\t{w}\t{w}\tx\t{'V' if k == 1 else 'X'}\n" for k, w in enumerate(words)), encoding="utf-8")
    cli.main(["align", str(tmp_path / "*.vert.tsv"), str(tmp_path / "out")])
    got = lines(tmp_path / "out/tokens")
    assert got[0].split("\t")[:2] == ["first", "second"] and len(got) == 5 and any("bello\tbella" in x for x in got), "the longer side is whole"
    assert len(lines(tmp_path / "out/rates")) == 2
    cli.main(["validate", str(tmp_path / "1_x.vert.tsv"), str(tmp_path / "faults")])
    assert lines(tmp_path / "faults")[1:] == ["0-1\terror\tunknown upos"]


def test_html(spark, tmp_path):
    (tmp_path / "t.csv").write_text("tu_id\tspeaker\tstart\tend\tduration\ttext\n0\tA\t0.0\t1.0\t1.0\t[ciao]\n", encoding="utf-8")
    cli.main(["csv2html", str(tmp_path / "t.csv"), str(tmp_path / "html")])
    assert '<p><span class="overlap">[ciao]</span></p>' in lines(tmp_path / "html")
