"""One person has one name afterwards, whatever real names the surrogates meet; forms of names, phones and tokens."""

import re

from parlance.llm import pii

TITLE = "|".join(pii.MALE + pii.FEMALE + pii.NEUTRAL)


def replaced(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.surrogates(rows).orderBy("doc_id").collect()]


def test_bare_names_are_replaced_once(spark):
    """Real people are named as surrogates are: every given name of the lists is one of a text."""
    people = [("Mr", given, family) for given, family in zip(pii.GIVEN["latin", "m"], ["Gadivizo", "Smith", "Adam", "Bruno", "Ridimafo", "Zocepoce", "Paul", "Oscar", *"ABCDEFGH"], strict=True) if len(family) > 1]
    texts = [" ".join(f"{t} {g} {f} came. {g} {f} left; {f} sat, {g} stood." for t, g, f in people[k : k + 3]) for k in range(len(people))]
    texts.append(" ".join(f"{t} {f} came; {f} left." for t, _, f in people))
    known = {}
    for old, new in zip(texts, replaced(spark, texts), strict=True):
        # each word of the text stands for one other word; brute force: align the two word by word
        a, b = re.findall(r"\w+", old), re.findall(r"\w+", new)
        assert len(a) == len(b)
        own = {}
        for x, y in zip(a, b, strict=True):
            assert own.setdefault(x, y) == y or x in {f for _, _, f in people} & {g for _, g, _ in people}, (x, y, own[x])
        for _, given, family in people:
            for whole in (f"{given} {family}",):
                if whole in old:
                    now = dict.fromkeys(m for i in range(len(a) - 1) if f"{a[i]} {a[i + 1]}" == whole for m in [f"{b[i]} {b[i + 1]}"])
                    assert len(now) == 1 and known.setdefault(whole, *now) == next(iter(now))
    names = {x.lower() for _, g, f in people for x in (g, f)}
    assert not names & {w.lower() for v in known.values() for w in v.split()}, "no surrogate is a name that the documents have, of whatever kind"


def test_forms(spark):
    texts = ["Call 0171 555 1234 or 06 12 34 56 78, not on 01 02 2024.", "Mr. O'Brien, MR JOHN SMITH and Mr van Gogh; O'Brien, van Gogh.", "Mrs Anne-Marie Le Pen: Le Pen, Anne-Marie.", "sk-" + "a1" * 4000 + " end", "ghp_" + "x" * 500, "Mr 5, Mr A. and mr smith"]
    got = replaced(spark, texts)
    phones = re.fullmatch(r"Call (0\d{3} \d{3} \d{4}) or (0\d \d\d \d\d \d\d \d\d), not on 01 02 2024\.", got[0])
    assert phones and phones[1] != "0171 555 1234" and phones[2] != "06 12 34 56 78"
    assert not re.search("O'Brien|JOHN|SMITH|Gogh", got[1]) and re.fullmatch(r"Mr\. (\w+), MR [A-Z]+ [A-Z]+ and Mr (\w+); \1, \2\.", got[1])
    assert re.fullmatch(r"Mrs (\w+) (\w+): \2, \1\.", got[2]) and "Pen" not in got[2]
    assert len(got[3]) == len(texts[3]) and "a1a1" not in got[3] and len(got[4]) == len(texts[4]) and "xxxx" not in got[4]
    assert got[5] == texts[5]
