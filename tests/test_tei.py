"""TEI documents as wholes."""

import xml.etree.ElementTree as ET

from parlance.operators import formats

COLUMNS = "transcript_id string, line long, token_id string, speaker string, tu_id long, unit string, id string, span string, form string, lemma string, upos string, xpos string, feats string, deprel string, type string, meta_label string, variation string, jefferson_feats string, align string, prolongations string, pace string, guesses string, overlaps string, sent_id string"
NS = {"t": "http://www.tei-c.org/ns/1.0"}


def token(line, tu, speaker, form, kind="linguistic", align="_", overlaps="_", sent="_"):
    return ("T1", line, f"{tu}-{line}", speaker, tu, "_", "_", form, form, "_", "_", "_", "_", "_", kind, "_", "none", "_", align, "_", "_", "_", overlaps, sent)


def test_header_spans_and_references(spark):
    rows = spark.createDataFrame([
        token(0, 0, "TOR1", "ciao", align="Begin=0.0", sent="1"), token(1, 0, "TOR1", "a", align="End=1.5", overlaps="0-1(1)", sent="2"), token(2, 1, "B<2", "(.)", "shortpause", align="Begin=1.0", sent="2"),
        token(3, 1, "B<2", "sì", align="End=2.0", overlaps="0-2(1)", sent="2"), token(4, 2, "TOR1", "no", sent="1"),
    ], COLUMNS)
    talks = spark.createDataFrame([("T1", 1, "00:10:05", "TOR1;B<2", "yes", "italian; dialect", "2020", "Torino & co", "x"), ("T1", 2, "1", "", "no", "", "", "", "")], "code string, line long, duration string, participants string, moderator string, languages string, year string, `collection-point` string, type string")
    people = spark.createDataFrame([("TOR1", 1, "F", "31-35", "_"), ("TOR1", 2, "M", "36-40", "Piemonte")], "code string, line long, gender string, `age-range` string, `birth-region` string")
    texts = formats.tei(rows, talks, participants=people, layers={"sent_id": "sentences"}, publisher="A corpus")
    assert formats.unresolved(texts).count() == 0
    root = ET.fromstring(texts.first().text)
    find = lambda path: [(e.text, dict(e.attrib)) for e in root.findall(path, NS)]
    persons = root.findall(".//t:person", NS)
    assert [p.get("role") for p in persons] == ["moderator", "participant"] and [p.find("t:persName", NS).text for p in persons] == ["TOR1", "B<2"]
    assert persons[0].find("t:sex", NS).get("value") == "2" and persons[0].find("t:age", NS).text == "36-40" and persons[0].find("t:birth/t:region", NS).text == "Piemonte" and persons[1].find("t:sex", NS) is None
    assert root.find(".//t:recording", NS).get("dur") == "PT10M5S" and find(".//t:publicationStmt/t:p") == [("A corpus", {})]
    assert find(".//t:langUsage/t:language") == [("Italian", {"ident": "ita"}), ("Dialect", {"ident": "it-x-dialect"})]
    assert find(".//t:setting/t:name") == [("Torino & co", {"type": "collection-point"})] and find(".//t:setting/t:date") == [(None, {"when": "2020"})]
    assert [a["type"] for _, a in find(".//t:bibl/t:note")] == ["type", "collection-point", "moderator"]
    ident = "{http://www.w3.org/XML/1998/namespace}id"
    assert [(a[ident], a["from"], a["to"]) for _, a in find(".//t:spanGrp/t:span")] == [("se1", "#w0-0", "#w2-4"), ("se2", "#w0-1", "#w1-3")]
    assert [a["absolute"] for _, a in find(".//t:when")] == ["PT0.000S", "PT1.000S", "PT1.500S", "PT2.000S"]
    broken = spark.createDataFrame([("T1", '<a xml:id="x"/><b who="#y" targets="#x #z"/>')], "transcript_id string, text string")
    assert sorted(r.ref for r in formats.unresolved(broken).collect()) == ["y", "z"]
