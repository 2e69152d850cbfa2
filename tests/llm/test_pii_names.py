"""Surnames don't run out, and rows without an id get second surrogates too."""

from parlance.llm import pii


def test_more_names_than_four_syllables_have(spark, monkeypatch):
    """Of two syllables there are 16 surnames of four, for 60 names of one title."""
    monkeypatch.setattr(pii, "SYLLABLES", {k: v[:2] for k, v in pii.SYLLABLES.items()})
    names = [f"Mr A{a}{b}" for a in "abcdefghij" for b in "abcdef"]
    texts = [(None, f"{n} spoke") for n in names]
    got = [r.text for r in pii.surrogates(spark.createDataFrame(texts * 2, "doc_id long, text string")).collect()]
    assert len(got) == 2 * len(texts) and len(set(got)) == len(texts)
