"""Quality classifier: Bradley-Terry scores from preference pairs, cut at a quantile.

A labelled document of label 1 is preferred to one of label 0. The strength of a document is linear
in features of its whole text; the weights minimise the logistic loss of the feature differences of
preference pairs. The cut is the quantile of the strengths of the labelled sample below which the
share of rejected labels lies; strengths are shifted so that the cut has the score THRESHOLD.

The model is fitted on at most SAMPLE labelled documents, those whose ids hash lowest, and on PAIRS
drawn pairs of them; only their feature rows reach the driver. Every document is scored.

Defined results: null text counts as empty, and an empty text has the score that its features give;
a document's score doesn't depend on other rows, so repeated rows score alike; rows with a null id
are scored and not held out (held_out is false); labels without a document, and labels other than 0
and 1, are ignored; equal labels of an id count once, an id with both labels is not learned from, and
rows of one id are learned from each, within the bound; where one of the two labels is missing there is nothing to prefer and every
score is 0.5. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_ids, fold, of_ids, whole_text

SAMPLE, PAIRS, THRESHOLD = 20_000, 200_000, 0.3

#: Classes of characters, by code point below 256; letters beyond stay letters.
LOWER, UPPER, DIGIT, BLANK, LINE, STOP, SHOUT, MARK, QUOTE, OTHER = range(10)
FEATURES = [
    "log_words", "lower", "upper", "digit", "line", "stop", "shout", "mark", "quote", "word_length", "long_words", "distinct", "distinct_root", "top_word", "stutter", "marked_words", "upper_words", "repeated_lines", "repeated_triples", "few_words", "no_words",
]


def class_table() -> np.ndarray:
    table = np.full(0x10000, OTHER, np.uint8)
    for code in range(0x10000):
        c = chr(code)
        if c.isupper():
            table[code] = UPPER
        elif c.isalpha():
            table[code] = LOWER
        elif c.isdigit():
            table[code] = DIGIT
        elif c in "\r\n\x0b\x0c\x85  ":
            table[code] = LINE
        elif c.isspace():
            table[code] = BLANK
        elif c in ".,;:。、，":
            table[code] = STOP
        elif c in "!?":
            table[code] = SHOUT
        elif c in "#$%&*|<>{}[]^~=+_/\\@`":
            table[code] = MARK
        elif c in "'\"-()«»“”‘’":
            table[code] = QUOTE
    return table


TABLE = class_table()


def features(text: str) -> list[float]:
    """FEATURES of a whole text."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    share = np.bincount(TABLE[np.minimum(codes, 0xFFFF)], minlength=10) / max(1, len(codes))
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * (len(FEATURES) - 2) + [1.0, 1.0]
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    triples = n - 2
    repeated = 1 - len(set(zip(words, words[1:], words[2:], strict=False))) / triples if triples > 0 else 0.0
    lines = [x for x in text.split("\n") if x]
    marked = sum(w[-1] in "#$%&*!|" or w[0] in "#$%&*|" for w in words)
    return [
        math.log1p(n), *share[[LOWER, UPPER, DIGIT, LINE, STOP, SHOUT, MARK, QUOTE]].tolist(), float(lengths.mean()), float((lengths > 20).mean()), len(counts) / n, len(counts) / math.sqrt(n), counts.most_common(1)[0][1] / n, stutter / n, marked / n, sum(w.isupper() and len(w) > 1 for w in words) / n, 1 - len(set(lines)) / max(1, len(lines)), repeated, float(n < 20), 0.0,
    ]


def spread(x: np.ndarray) -> np.ndarray:
    """Shares near 0 matter as much as large ones: every feature, and its square root."""
    return np.hstack([x, np.sqrt(np.abs(x))])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        strength = np.clip((spread(x) - self.mean) / self.scale, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip(strength + self.shift, -40, 40)))


def fitted(x: np.ndarray, label: np.ndarray, threshold: float = THRESHOLD, pairs: int = PAIRS, penalty: float = 1e-3, steps: int = 400) -> Model:
    """Bradley-Terry weights from preference pairs of rows of `x`, and the shift that puts the cut at `threshold`."""
    wide = spread(x)
    mean, scale = (wide.mean(axis=0), wide.std(axis=0) + 1e-6) if len(wide) else (np.zeros(2 * len(FEATURES)), np.ones(2 * len(FEATURES)))
    z = np.clip((wide - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    w = np.zeros(z.shape[1])
    if not len(good) or not len(bad):
        return Model(mean, scale, w, 0.0)
    draw = np.random.default_rng(7)
    a, b = draw.choice(good, pairs), draw.choice(bad, pairs)
    first, second = np.zeros_like(w), np.zeros_like(w)
    size = min(pairs, 20_000)
    for step in range(1, steps + 1):
        some = draw.integers(0, pairs, size)
        difference = z[a[some]] - z[b[some]]
        doubt = 1 / (1 + np.exp(np.clip(difference @ w, -40, 40)))
        slope = penalty * w - difference.T @ doubt / size
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w = w - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    cut = float(np.quantile(z @ w, len(bad) / (len(good) + len(bad))))
    return Model(mean, scale, w, math.log(threshold / (1 - threshold)) - cut)


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, label, text) to (label, x)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    return docs.mapInArrow(work, "doc_id long, label int, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> Model:
    """Learn from the labelled rows that aren't held out, `sample` of them at most."""
    marked = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").where(fold(labels) != 0)
    marked = marked.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id")).join(marked, "doc_id")
    taken = bounded_ids(ids.select("doc_id"), sample)
    some = of_ids(marked, taken)
    rows = of_ids(docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")), taken).join(F.broadcast(some), "doc_id").select("doc_id", "label", "text")
    got = sorted(featured(rows).collect())
    return fitted(np.array([r.x for r in got]).reshape(-1, len(FEATURES)), np.array([r.label for r in got], int), threshold)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(np.array([features(t.as_py()) for t in batch.column("text")]).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(fold(docs, doc_id) == 0, F.lit(False)).alias("held_out"), whole_text(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that the model doesn't reject. One pass, nothing is moved."""
    schema, place = docs.schema, docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(np.array([features(t.as_py() or "") for t in batch.column(place)]).reshape(-1, len(FEATURES)))
            yield batch.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(work, schema)
