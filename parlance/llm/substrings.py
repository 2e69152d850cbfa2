"""Substring deduplication by level-wise doubling: words of repeated windows go, but for the first document's.

A window is `window` consecutive words of one document (13). Whether it is repeated is asked level by
level: of the short windows inside it, the one with the least hash stands for it, so equal windows
are stood for by equal short ones. Short windows found in one document alone are dropped, with the
windows they stand for; what is left is extended to twice the length and asked again, until the
length is that of the window or no candidates survive. The hash of a window is made from those of
its two halves, so each level doubles the one before. The last level compares whole windows, by 96
bits (two hashes that are made independently); the levels before only sift.

Inside a task, chunks of bounded size are compared first: what is repeated in a chunk is known at
once and isn't asked again, and a chunk asks for each of its windows once, so a window that very many
documents share has as many rows in the shuffle as there are chunks. The answers are positions; they
return to the texts by a join on the row. Texts move twice, in the two joins.

Defined results: null text has no words; documents of fewer words than the window keep them all; a
window repeated only inside one document stays; rows with equal ids are one document here, so they
don't remove from each other; a null id counts as larger than all others. Windows are judged on the
input. Repeated rows are returned as often as they come. An empty table gives no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, whole_text
from .common import removed as delete
from .shingles import MULTIPLY, mixed

WINDOW = 13
#: Rows that a task compares at a time.
CHUNK = 1_000_000
NO_ID = 2**63 - 1


class Words(dict):
    """Word to its place in two arrays of hashes. `texts` empties it between texts when it is full."""

    def __init__(self, most: int = 400_000):
        self.most = most
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.first, self.second = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at == len(self.first):
            self.first, self.second = np.r_[self.first, self.first], np.r_[self.second, self.second]
        whole = xxhash.xxh3_128_intdigest(word)
        self.first[at], self.second[at] = whole & 0xFFFFFFFFFFFFFFFF, whole >> 64
        self[word] = at
        return at

    def lanes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of every word of a text. bytes.split parts at the six white characters of ASCII only."""
        if len(self) > self.most:
            self.empty()
        found = text.encode().split()
        at = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        return self.first[at], self.second[at]


def doubled(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of every window of so many words: of two halves, each of them of two halves; the last pair may overlap."""
    count = len(words) - length + 1
    if count <= 0:
        return words[:0]
    size, got = 1, words
    while 2 * size <= length:
        got = mixed(got[:-size] * MULTIPLY + got[size:])
        size *= 2
    return got[:count] if size == length else mixed(got[:count] * MULTIPLY + got[length - size : length - size + count] + np.uint64(length))


def standing(hashes: np.ndarray, length: int, window: int) -> np.ndarray:
    """For every window, the least hash of the short windows inside it."""
    width, size, got = window - length + 1, 1, hashes
    count = len(hashes) - width + 1
    if count <= 0:
        return hashes[:0]
    while 2 * size <= width:
        got = np.minimum(got[:-size], got[size:])
        size *= 2
    return got[:count] if size == width else np.minimum(got[:count], got[width - size : width - size + count])


def levels(window: int, start: int) -> list[int]:
    """Lengths from the first to the window's, each twice the one before at most."""
    out = [min(start, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def live(words: np.ndarray, batch: pa.RecordBatch, i: int, before: int, window: int) -> np.ndarray:
    """Which windows of the i-th text are candidates: those whose standing window survived the level before."""
    if not before:
        return np.ones(max(0, len(words) - window + 1), bool)
    return np.isin(standing(doubled(words, before), before, window), batch.column("alive")[i].values.to_numpy().view(np.uint64))


def sifted(rows: DataFrame, window: int, length: int, before: int, chunk: int) -> DataFrame:
    """Rows (row, hash): the standing windows of this length that more than one document has."""

    def asked(parts: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
        sizes = [len(p[0]) for p in parts]
        hashes = np.concatenate([p[0] for p in parts])
        own, row = np.repeat([p[1] for p in parts], sizes), np.repeat([p[2] for p in parts], sizes)
        order = np.lexsort((own, hashes))
        hashes, own, row = hashes[order], own[order], row[order]
        starts = runs(hashes)
        sizes = np.diff(np.r_[starts, len(hashes)])
        low, high = np.repeat(own[starts], sizes), np.repeat(own[starts + sizes - 1], sizes)
        first = np.zeros(len(hashes), bool)
        first[starts] = True
        # A second row of a document is taken along unasked: these levels may keep too much, not too little.
        sure = ~first | (low < high)
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(low), pa.array(high), pa.array(row), pa.array(row, mask=first), pa.array(sure)], ["hash", "low", "high", "row", "apart", "sure"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, held = Words(), [], 0
        for batch in batches:
            own, row = batch.column("own").to_pylist(), batch.column("row").to_pylist()
            for i, text in enumerate(batch.column("text")):
                words = known.lanes(text.as_py())[0]
                found = np.unique(standing(doubled(words, length), length, window)[live(words, batch, i, before, window)])
                if len(found):
                    parts.append((found, own[i], row[i]))
                    held += len(found)
                if held >= chunk:
                    yield asked(parts)
                    parts, held = [], 0
        if parts:
            yield asked(parts)

    found = rows.mapInArrow(work, "hash long, low long, high long, row long, apart long, sure boolean")
    every = Window.partitionBy("hash", "apart")
    return found.withColumns({"least": F.min("low").over(every), "most": F.max("high").over(every)}).where("sure or least < most").select("row", "hash")


def starts(rows: DataFrame, window: int, before: int, chunk: int) -> DataFrame:
    """Rows (row, at): the windows, by their first word, whose sequence a document with a smaller id has too."""

    def lists(sizes: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values, kind))

    def asked(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, int, int]]) -> Iterator[pa.RecordBatch]:
        sizes = [len(p[0]) for p in parts]
        a, b, at = (np.concatenate([p[k] for p in parts]) for k in range(3))
        own, row = np.repeat([p[3] for p in parts], sizes), np.repeat([p[4] for p in parts], sizes)
        order = np.lexsort((own, b, a))
        a, b, at, own, row = a[order], b[order], at[order], own[order], row[order]
        groups = runs(a, b)
        least = np.repeat(own[groups], np.diff(np.r_[groups, len(a)]))
        names = ["a", "b", "own", "rows", "at", "apart", "sure"]
        # in the chunk's first document: asked, one row for each window
        open_ = own == least
        begin = runs(a[open_], b[open_])
        counts = np.diff(np.r_[begin, open_.sum()])
        yield pa.RecordBatch.from_arrays([pa.array(a[open_][begin].view(np.int64)), pa.array(b[open_][begin].view(np.int32)), pa.array(own[open_][begin]), lists(counts, row[open_], pa.int64()), lists(counts, at[open_], pa.int32()), pa.nulls(len(begin), pa.int64()), pa.array(np.zeros(len(begin), bool))], names)
        # in a later one of the chunk: known, one row for each text
        shut = np.flatnonzero(~open_)
        shut = shut[np.argsort(row[shut], kind="stable")]
        begin = runs(row[shut])
        counts = np.diff(np.r_[begin, len(shut)])
        zero = np.zeros(len(begin), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(zero), pa.array(zero.astype(np.int32)), pa.array(own[shut][begin]), lists(counts, row[shut], pa.int64()), lists(counts, at[shut], pa.int32()), pa.array(row[shut][begin]), pa.array(np.ones(len(begin), bool))], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, held = Words(), [], 0
        for batch in batches:
            own, row = batch.column("own").to_pylist(), batch.column("row").to_pylist()
            for i, text in enumerate(batch.column("text")):
                first, second = known.lanes(text.as_py())
                at = np.flatnonzero(live(first, batch, i, before, window))
                if len(at):
                    parts.append((doubled(first, window)[at], (doubled(second, window)[at] >> np.uint64(32)).astype(np.uint32), at, own[i], row[i]))
                    held += len(at)
                if held >= chunk:
                    yield from asked(parts)
                    parts, held = [], 0
        if parts:
            yield from asked(parts)

    found = rows.mapInArrow(work, "a long, b int, own long, rows array<long>, at array<int>, apart long, sure boolean")
    least = F.min("own").over(Window.partitionBy("a", "b", "apart"))
    gone = found.withColumn("least", least).where("sure or own > least").select(F.explode(F.arrays_zip("rows", "at")).alias("x"))
    return gone.select(F.col("x.rows").alias("row"), F.col("x.at").alias("at"))


def row_key(docs: DataFrame, doc_id: Column, text: Column) -> Column:
    """What tells rows apart: the id if no id comes twice, else a hash of id and text (rows equal in both have equal answers)."""
    twice = docs.select(doc_id.alias("i")).groupBy("i").agg(F.count("*").alias("n")).where("n > 1 or i is null").isEmpty()
    return doc_id if twice else F.xxhash64(doc_id, text)


def repeats(docs: DataFrame, window: int = WINDOW, start: int | None = None, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """The documents as rows (doc_id, text, row), and the starts of the windows to be removed as rows (row, at); None if there are none."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    rows = rows.withColumn("row", row_key(rows, F.col("doc_id"), F.col("text")))
    left, before, last = rows.withColumn("own", F.coalesce("doc_id", F.lit(NO_ID))).drop("doc_id"), 0, None
    for length in levels(window, start or -(-window // 2)):
        candidates = left
        if last:
            alive = last[0].groupBy("row").agg(F.collect_set("hash").alias("alive"))
            candidates = left.join(alive, "row")
        found = settled(starts(candidates, window, before, chunk) if length == window else sifted(candidates, window, length, before, chunk), "windows")
        if last:
            delete(docs.sparkSession, last[1])
        last, before = found, length
        if last[0].isEmpty():
            return rows, None
    return rows, last[0]


def dedup(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, and `kept`, the words that stay joined by one space."""
    rows, gone = repeats(docs, window, **how)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, kept = [], []
            for text, at in zip(batch.column("text"), batch.column("at"), strict=True):
                words = text.as_py().encode().split()
                gone = 0
                if at.is_valid and len(at.values):
                    ends = np.zeros(len(words) + 1, np.int64)
                    places = at.values.to_numpy()
                    np.add.at(ends, places, 1)
                    np.add.at(ends, places + window, -1)
                    covered = np.cumsum(ends[:-1]) > 0
                    gone = int(covered.sum())
                    words = [words[k] for k in np.flatnonzero(~covered)]
                counts.append((len(words) + gone, gone))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for n, _ in counts], pa.int64()), pa.array([g for _, g in counts], pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    if gone is None:
        found = rows.withColumn("at", F.lit(None).cast("array<int>"))
    else:
        found = rows.join(gone.groupBy("row").agg(F.collect_set("at").alias("at")), "row", "left")
    return found.select("doc_id", "text", "at").mapInArrow(work, "doc_id long, n_words long, n_removed long, kept string")


ORACLE_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     p AS (SELECT r, doc_id, i, sha256(array_to_string(ws[i:i + 12], ' ')) AS h FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
     least AS (SELECT h, min(doc_id) AS first FROM p GROUP BY h HAVING min(doc_id) < max(doc_id)),
     gone AS (SELECT DISTINCT r, i + unnest(range(0, 13)) AS i FROM p JOIN least USING (h) WHERE doc_id > first),
     words AS (SELECT r, i, ws[i] AS word FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
     kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (r)
"""
