"""One record a row, whatever the ids."""

import hashlib

from parlance.llm import warc


def test_missing_and_repeated_ids(spark):
    a, b, c = "x" * 150, "y" * 150, "z" * 150
    rows = [(None, "u", a), (1, "u", a), (1, "u", a), (1, "u", a), (1, "v", b), (2, "u", a), (3, "u", b), (None, None, None), (None, "u", c), (None, "u", c), (4, "u", "short"), (4, "u", "short")]
    got = sorted((tuple(r) for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)
    want = []
    for i, _, p in rows:
        data = (p or "").encode()
        first = min((j for j, _, q in rows if (q or "") == (p or "") and j is not None), default=None)
        again = len(data) >= 100 and i is not None and i != first
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=str)
