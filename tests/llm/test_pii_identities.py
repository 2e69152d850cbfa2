"""Identities across forms, check digits, and surrogates that are nobody else's."""

import random
import re

from parlance.llm import pii

from .test_operators import SCHEMA


def new_texts(spark, texts, **how):
    rows = [(i if i % 2 else None, t) for i, t in enumerate(texts)]
    got = pii.surrogates(spark.createDataFrame([(i, f"#{k}# {t}") for k, (i, t) in enumerate(rows)], SCHEMA), **how).collect()
    by = {int(re.match(r"#(\d+)#", r.text)[1]): r for r in got}
    return [by[k].text.split("# ", 1)[1] for k in range(len(texts))], [by[k] for k in range(len(texts))]


def test_forms_of_one_identity(spark):
    texts = ["Mr John Smith wrote. John Smith left; Smith stayed, Smithson too", "Mrs Smith and Dr. Anna Smith", "Mr SMITH", "mail A.B@x.com or a.b@X.COM", "Señor Ivan Petrov", "господин Иван Петров, госпожа Петрова"]
    new, rows = new_texts(spark, texts)
    first, last = new[0].split()[1:3]
    assert first in pii.GIVEN["latin", "m"] and new[0] == f"Mr {first} {last} wrote. {first} {last} left; {last} stayed, Smithson too"
    assert new[1].split()[1] == last and new[1].endswith(last) and new[2] == f"Mr {last.upper()}"
    assert new[3].split()[1] == new[3].split()[3] and rows[3].n_entities == 2
    assert "Petrov" not in new[4] and not re.search("Иван|Петров", new[5]) and re.search(r"господин \w+ \w+в, госпожа \w+ва", new[5])


def mod97(code):
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


def test_numbers_with_check_digits(spark):
    iban, other = "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32"
    texts = [iban, other, "DE89370400440532013000", "4111 1111 1111 1111", "4111 1111 1111 1112", "2001:db8::ff00:42:8329 12:30:45", "call 555-123-4567 or (555) 123-4567", "ghp_" + "a1B2" * 9, "+1 (843) 555-7672 170.106.47.218"]
    new, rows = new_texts(spark, texts, check_digits=True)
    assert new[0] != iban and re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", new[0]) and mod97(new[0].replace(" ", "")) == 1
    assert new[1] == other and rows[1].n_entities == 0 and mod97(new[2]) == 1 and new[2] != texts[2]
    assert new[3] != texts[3] and new[4] == texts[4] and rows[4].kinds == ""
    assert re.fullmatch(r"[0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{2}:[0-9a-f]{4} 12:30:45", new[5]) and new[5] != texts[5]
    assert rows[6].n_entities == 2 and "123-4567" not in new[6] and re.fullmatch(r"call \d{3}-\d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}", new[6])
    assert new[7].startswith("ghp_") and len(new[7]) == 40 and new[7] != texts[7]
    assert rows[8].kinds == "ip,phone"
    assert new_texts(spark, texts[1:2])[0] != [other]


def test_surrogates_are_no_ones_own(spark, monkeypatch):
    """Names of two syllables, most of which are in the documents: no surrogate is a name that the documents have."""
    monkeypatch.setattr(pii, "SYLLABLES", {k: v[:2] for k, v in pii.SYLLABLES.items()})
    from itertools import product

    names = ["".join(p).capitalize() for p in product(["ba", "ce"], repeat=4)]
    new, _ = new_texts(spark, [f"Mr {n}" for n in names])
    own = [t.split()[1] for t in new]
    assert len(set(own)) == len(names) and not set(own) & set(names)


def test_all_identities_of_a_corpus(spark):
    """Brute force over all finds: as many surrogates as identities, none of them kept, the rest of every text untouched."""
    rng = random.Random(4)
    made = {
        "mail": [f"u{k}.{rng.choice('ab')}@h{k % 7}.org" for k in range(60)], "ip": [f"10.0.{k}.{k}" for k in range(60)],
        "ssn": [f"{100 + k}-22-3333" for k in range(60)], "name": [f"Mrs {''.join(rng.choice('aeiou') for _ in range(6)).capitalize()}" for _ in range(60)],
    }
    every = [x for some in made.values() for x in some]
    texts, used = [], []
    for _ in range(300):
        some = [rng.choice(every) for _ in range(rng.randint(0, 4))]
        used.append(some)
        texts.append(" and ".join(["start", *(f"<{x}>" for x in some), "end"]))
    new, rows = new_texts(spark, texts)
    by = {}
    for some, text, row in zip(used, new, rows, strict=True):
        got = re.findall(r"<(.*?)>", text)
        assert row.n_entities == len(some) == len(got) and re.sub("<.*?>", "", text) == " and ".join(["start", *[""] * len(some), "end"])
        for old, x in zip(some, got, strict=True):
            assert by.setdefault(old, x) == x != old
    assert len(set(by.values())) == len(by)


def test_marks_in_a_text_and_empty_tables(spark):
    texts = [f"{pii.MARK} a@b.org {pii.ESCAPE}{pii.PLAIN} x", pii.MARK, "no entity"]
    new, rows = new_texts(spark, texts)
    assert new[0].startswith(f"{pii.MARK} ") and new[0].endswith(f" {pii.ESCAPE}{pii.PLAIN} x") and rows[0].n_entities == 1 and new[1:] == texts[1:]
    assert pii.surrogates(spark.createDataFrame([], SCHEMA)).count() == 0
