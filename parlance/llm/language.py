"""Language identification: a mixture of languages in every document, by expectation-maximisation.

Each language has a distribution over hashed letter trigrams. A document's language proportions are
those that make its trigrams likeliest (EM), for the best language alone, the best two, and so on
while a penalised likelihood still rises: a language more must gain more than PENALTY times the
logarithm of the number of trigrams. The prediction is the largest proportion of the chosen set. Its
score is its proportion among all languages, drawn towards an even share by one trigram a language,
so that short texts and texts that several languages explain score low.

The distributions are counted on at most SAMPLE documents with a language, those whose ids hash
lowest, for the LANGUAGES languages that most of them have; the TOP most frequent trigrams of each
reach the driver, which holds a share for every trigram and language (a megabyte a language). Every
document is scored.

Defined results: `und` with score 0 if the text is null or has no letter; ties between languages go
to the first in alphabetical order; repeated rows are predicted alike; rows with a null id are
predicted, not learned from and not held out; without any row to learn from, every prediction is
`und`. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_ids, fold, of_ids, whole_text

SAMPLE, LANGUAGES, TOP, BITS = 20_000, 100, 40_000, 18
PENALTY, SMOOTH, STEPS = 3.0, 0.5, 25


@functools.lru_cache(1)
def letter_table() -> np.ndarray:
    """By code point: the code point if it is a letter, else 0."""
    return np.array([c if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint32)


def trigrams(text: str) -> np.ndarray:
    """Hashes of the letter trigrams of a text, in order; a run of other characters counts as one edge of a word."""
    codes = letter_table()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    codes = np.r_[np.uint32(0), codes, np.uint32(0)].astype(np.uint64)
    codes = codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    h = ((a * np.uint64(0x1F123BB5)) ^ (b * np.uint64(0x9E3779B1)) ^ (c * np.uint64(0x85EBCA77))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)[b != 0]


@dataclass
class Languages:
    names: list[str]
    #: share of every trigram, one column a language
    table: np.ndarray

    def mixture(self, shares: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions of the languages of `shares`, and the log-likelihood under them."""
        part = np.full(shares.shape[1], 1 / shares.shape[1])
        if len(part) > 1:
            total = weight.sum()
            for _ in range(STEPS):
                old, each = part, shares * part
                part = (weight / each.sum(axis=1)) @ each / total
                if np.abs(part - old).max() < 1e-3:
                    break
        return part, float(weight @ np.log(shares @ part))

    def predict(self, text: str) -> tuple[str, float]:
        found = trigrams(text)
        if not len(found) or not self.names:
            return "und", 0.0
        places, weight = np.unique(found, return_counts=True)
        weight, shares = weight.astype(float), self.table[places]
        part, _ = self.mixture(shares, weight)
        order = np.argsort(-part, kind="stable")
        best, chosen, shape = None, None, None
        for size in range(1, len(order) + 1):
            own = order[:size]
            fit, likely = self.mixture(shares[:, own], weight)
            value = likely - PENALTY * (size - 1) * math.log(len(found))
            if best is not None and value <= best:
                break
            best, chosen, shape = value, own, fit
        top = max(range(len(chosen)), key=lambda k: (round(shape[k], 12), -chosen[k]))
        sure = (len(found) * part[chosen[top]] + 1) / (len(found) + len(self.names))
        return self.names[chosen[top]], float(min(1.0, sure))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, top: int = TOP, languages: int = LANGUAGES) -> Languages:
    """Learn from the rows with a language that aren't held out, `sample` of them and `languages` languages at most."""
    known = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), whole_text(text).alias("text")).where("doc_id is not null and lang is not null")
    known = known.where(fold(known) != 0)
    some = of_ids(known, bounded_ids(known.select("doc_id"), sample)).select("lang", "text")
    # as many rows at most as the sample has
    most = some.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    some = some.join(F.broadcast(most.select("lang")), "lang", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                total = counts.setdefault(name, np.zeros(1 << BITS, np.int64))
                total += np.bincount(trigrams(value.as_py()), minlength=1 << BITS)
        for name, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "gram", "n"])

    counted = some.mapInArrow(work, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("r") <= top)
    rows = ranked.select("lang", "gram", "n").toPandas()
    names = sorted(rows["lang"].unique())
    table = np.full((1 << BITS, len(names)), SMOOTH, np.float32)
    for k, name in enumerate(names):
        own = rows[rows["lang"] == name]
        table[own["gram"].to_numpy(), k] += own["n"].to_numpy()
    if names:
        table /= table.sum(axis=0, dtype=np.float64).astype(np.float32)
    return Languages(names, table)


def predict(docs: DataFrame, model: Languages, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    # Its size is bounded: 2**BITS trigrams for each of at most LANGUAGES languages.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            got = [own.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(fold(docs, doc_id) == 0, F.lit(False)).alias("held_out"), whole_text(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")
