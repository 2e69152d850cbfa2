"""Only what has changed is read and written."""

import glob
import os

from parlance.streaming import sync

HEAD = "tu_id\tspeaker\tstart\tend\tduration\ttext\n"


def put(path, text):
    path.write_text(f"{HEAD}0\tA\t0.0\t1.0\t1.0\t{text}\n", encoding="utf-8")


def test_new_changed_touched_and_vanished_files(spark, tmp_path):
    source, out = tmp_path / "in", f"{tmp_path}/out"
    source.mkdir()
    for name, text in (("BOA1", "ho 2 case"), ("BOA 2", "ciao"), ("BOA3", "sì °no"), ("PBB1", "ma va")):
        put(source / f"{name}.csv", text)
    run = lambda: sync.sync(spark, f"{source}/*.csv", out)
    parts = lambda kind: {p.rsplit("/", 2)[-2]: p for p in glob.glob(f"{out}/{kind}/*/part*")}
    text = lambda kind: {k: open(p).read() for k, p in parts(kind).items()}
    first = run()
    assert first.changed == ["BOA 2", "BOA1", "BOA3", "PBB1"] and first.opened == 4 and len(parts("vert")) == 4 and len(parts("log")) == 2
    pages = text("log")
    assert any("|BOA1 |NUMBERS:1 |_" in t for t in pages.values())
    before = parts("vert") | {f"log/{k}": v for k, v in parts("log").items()}
    assert (run().opened, run().changed) == (0, [])
    put(source / "BOA1.csv", "ho 2 case e 3 gatti")
    os.remove(source / "BOA3.csv")
    os.utime(source / "PBB1.csv", (1, 1))
    got = run()
    assert (got.changed, got.vanished, got.opened) == (["BOA1"], ["BOA3"], 2), "a file that was only touched is opened, and not processed"
    after = parts("vert") | {f"log/{k}": v for k, v in parts("log").items()}
    assert "transcript_id=BOA3" not in after and after["transcript_id=BOA1"] != before["transcript_id=BOA1"]
    other = [k for k in before if "PBB" in k or "2" in k or "ParlaBO" in k]
    assert len(other) == 3 and all(after[k] == before[k] for k in other), "no file of another transcript or module was written"
    assert any("|BOA1 |NUMBERS:2 |_" in t for t in text("log").values()) and not any("UNBALANCED" in t for t in text("errors").values())
    assert spark.read.parquet(f"{out}/summary").count() == 3 and run().opened == 0
    for p in source.glob("*.csv"):
        p.unlink()
    assert len(run().vanished) == 3 and not parts("vert") and not parts("log")
