"""Sequences held against each other: global alignment, error rate, turns against units."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAP = "_"
STEPS = T.ArrayType(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))


def aligned_pairs(a: list[str], b: list[str], match: float = 1.0, mismatch: float = -1.0, indel: float = -1.0) -> list[tuple[str, str]]:
    """A global alignment of the highest score. Of equal ones it prefers a pair, then a gap in b, reading from the end."""
    n, m = len(a), len(b)
    score = np.zeros((n + 1, m + 1))
    score[:, 0], score[0, :] = indel * np.arange(n + 1), indel * np.arange(m + 1)
    other = np.array(b, dtype=object)
    along = indel * np.arange(1, m + 1)
    for i in range(1, n + 1):
        pair = score[i - 1, :-1] + np.where(other == a[i - 1], match, mismatch)
        best = np.maximum(pair, score[i - 1, 1:] + indel)
        # gaps along the row, all at once: a running maximum without the slope of the gaps
        score[i, 1:] = np.maximum(np.maximum.accumulate(best - along), score[i, 0]) + along
    out, i, j = [], n, m
    while i or j:
        if i and j and np.isclose(score[i, j], score[i - 1, j - 1] + (match if a[i - 1] == b[j - 1] else mismatch)):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif i and np.isclose(score[i, j], score[i - 1, j] + indel):
            i -= 1
            out.append((a[i], GAP))
        else:
            j -= 1
            out.append((GAP, b[j]))
    return out[::-1]


@F.pandas_udf(STEPS)
def align(a: pd.Series, b: pd.Series) -> pd.Series:
    """The alignment of two arrays of text, row by row; null counts as empty."""
    whole = lambda x: [] if x is None else ["" if t is None else t for t in x]
    return pd.Series([[{"a": p, "b": q} for p, q in aligned_pairs(whole(x), whole(y))] for x, y in zip(a, b, strict=True)])


def alignment_rows(pairs: DataFrame, keys: list[str], a: str = "a", b: str = "b", ids: tuple[str, str] | None = None) -> DataFrame:
    """Rows (keys, position, a, b, match): 0 equal, 1 a gap, 2 a substitution.

    `ids`: two array columns that name the tokens of either side; adds id_a and id_b, `_` at gaps.
    """
    if ids:
        aligned = pairs.select(*keys, *ids, F.posexplode(align(F.col(a), F.col(b))).alias("position", "x"))
        so_far = Window.partitionBy(*keys).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
        # how many tokens of a side stand up to a place says which token stands there
        name = lambda c, of: F.when(F.col(f"x.{c}") == GAP, GAP).otherwise(F.get(of, (F.count_if(F.col(f"x.{c}") != GAP).over(so_far) - 1).cast("int"))).alias(f"id_{c}")
        rows = aligned.select(*keys, "position", "x.a", "x.b", name("a", ids[0]), name("b", ids[1]))
    else:
        rows = pairs.select(*keys, F.posexplode(align(F.col(a), F.col(b))).alias("position", "x")).select(*keys, "position", "x.a", "x.b")
    return rows.withColumn("match", F.when((F.col("a") == GAP) | (F.col("b") == GAP), 1).when(F.col("a") == F.col("b"), 0).otherwise(2))


def error_rate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per pair substitutions, deletions, insertions, n, wer, score and distance.

    The distance is the mean of 0 for equal, 1 for substituted and 0.5 for gaps; the score that of 1, 0.5 and 0.
    """
    s, i, d = F.count_if((F.col("match") == 2)), F.count_if(F.col("a") == GAP), F.count_if((F.col("b") == GAP) & (F.col("a") != GAP))
    n = F.count_if(F.col("a") != GAP)
    return rows.groupBy(*keys).agg(s.alias("substitutions"), d.alias("deletions"), i.alias("insertions"), n.alias("n"), F.when(n == 0, 0.0).otherwise((s + d + i) / n).alias("wer"), F.avg(F.when(F.col("match") == 0, 1.0).when(F.col("match") == 2, 0.5).otherwise(0.0)).alias("score"), F.avg(F.when(F.col("match") == 0, 0.0).when(F.col("match") == 2, 1.0).otherwise(0.5)).alias("distance"))


def timed_tokens(vert: DataFrame) -> DataFrame:
    """Rows (path, tokens, ids, ends, length) of token tables, for file_pairs: a unit ends where its `align` says (`End=`), a file where the unit that starts last ends."""
    time = lambda name: F.regexp_extract(F.col("align"), rf"(?:^|\|){name}=([0-9.]+)", 1).try_cast("double") if "align" in vert.columns else F.lit(None).cast("double")
    unit = Window.partitionBy("transcript_id", "tu_id")
    rows = vert.withColumns({"__begin": F.min(time("Begin")).over(unit), "__end": F.max(time("End")).over(unit)})
    tokens = F.sort_array(F.collect_list(F.struct("line", "form", "token_id", "__end")))
    got = rows.groupBy(F.col("transcript_id").alias("path")).agg(tokens.alias("t"), F.max_by("__end", F.when(F.col("__end").isNotNull(), F.col("__begin"))).alias("length"))
    return got.select("path", F.col("t.form").alias("tokens"), F.col("t.token_id").alias("ids"), F.col("t.__end").alias("ends"), "length")


def file_pairs(files: DataFrame) -> DataFrame:
    """Pairs of transcriptions of one recording: rows (path, tokens) whose names are `N_base`, the lower number first.

    With a column `ends` (the end of each token's unit, in order of the tokens) and `length` (the end
    of the last unit) both sides are cut where the shorter recording ends; a pair of which a side has
    no times is aligned whole. A column `ids` (the tokens' ids) is cut likewise, to ids_a and ids_b.
    """
    ends = F.col("ends") if "ends" in files.columns else F.lit(None).cast("array<double>").alias("ends")
    length = F.col("length") if "length" in files.columns else F.lit(None).cast("double").alias("length")
    ids = F.col("ids") if "ids" in files.columns else F.lit(None).cast("array<string>").alias("ids")
    named = files.select("path", "tokens", ids, ends, length, F.regexp_extract("path", r"(\d+)_([^/]*)$", 1).cast("int").alias("n"), F.regexp_extract("path", r"(\d+)_([^/]*)$", 2).alias("base")).where("base <> ''")
    x, y = named.alias("x"), named.alias("y")
    got = x.join(y, (F.col("x.base") == F.col("y.base")) & (F.col("x.n") < F.col("y.n")))
    shared = F.when(F.col("x.length").isNotNull() & F.col("y.length").isNotNull(), F.least("x.length", "y.length"))
    # a token whose unit has no end isn't past it
    inside = lambda s, of="tokens": F.when(shared.isNull(), F.col(f"{s}.{of}")).otherwise(F.filter(f"{s}.{of}", lambda _, i: F.coalesce(F.get(f"{s}.ends", i) <= shared, F.lit(True))))
    return got.select(F.col("x.base").alias("base"), F.col("x.n").alias("first"), F.col("y.n").alias("second"), shared.isNotNull().alias("timed"), inside("x").alias("a"), inside("y").alias("b"), *[inside(s, "ids").alias(c) for s, c in (("x", "ids_a"), ("y", "ids_b")) if "ids" in files.columns])


def turns_to_units(turns: DataFrame, units: DataFrame, key: str = "transcript_id") -> DataFrame:
    """Rows (key, turn, tu_id): each turn's unit, the k-th of equal speaker and text to the k-th. Turns without one have null."""
    by = lambda order: Window.partitionBy(key, "speaker", "text").orderBy(order)
    left = turns.withColumn("k", F.row_number().over(by("turn")))
    right = units.withColumn("k", F.row_number().over(by("tu_id"))).select(key, "speaker", "text", "k", "tu_id")
    return left.join(right, [key, "speaker", "text", "k"], "left").select(key, "turn", "tu_id")


def turns_by_cursor(turns: DataFrame, units: DataFrame, key: str = "transcript_id", back: int = 3) -> DataFrame:
    """Rows (key, turn, tu_id): the units of turns, found by going through both in order. A group is one transcript.

    A turn's unit is the first of its speaker and text at or after the place behind the unit of the
    turn before; where there is none, the first of the `back` units before that place. Blanks around
    a turn don't count, units without text are passed over. A turn without a unit has null and moves
    nothing on; nor has a turn without speaker or text one.
    """
    kinds = {**dict(turns.dtypes), "tu_id": dict(units.dtypes)["tu_id"]}

    def work(said: pa.Table, known: pa.Table) -> pa.Table:
        said, known = said.sort_by("turn"), known.sort_by("tu_id")
        ids = [i for i, x in zip(known["tu_id"].to_pylist(), known["text"].to_pylist(), strict=True) if x]
        places: dict[tuple[str, str], list[int]] = defaultdict(list)
        for place, what in enumerate((s, x) for s, x in zip(known["speaker"].to_pylist(), known["text"].to_pylist(), strict=True) if x):
            places[what].append(place)
        found, at = [], 0
        for speaker, text in zip(said["speaker"].to_pylist(), said["text"].to_pylist(), strict=True):
            own = places.get((speaker.strip(), text.strip()), []) if speaker is not None and text is not None else []
            ahead = bisect_left(own, at)
            k = ahead if ahead < len(own) else bisect_left(own, at - back)
            found.append(ids[own[k]] if k < len(own) else None)
            at = own[k] + 1 if k < len(own) else at
        return pa.table({key: said[key], "turn": said["turn"], "tu_id": pa.array(found, known["tu_id"].type)})

    left, right = turns.select(key, "turn", "speaker", "text"), units.select(key, "tu_id", "speaker", "text")
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(work, ", ".join(f"{c} {kinds[c]}" for c in (key, "turn", "tu_id")))


def word_cursor(forms: list[str], words: list[str]) -> list[int | None]:
    """For each form the place of its word: the next one, or that after it if the next doesn't fit."""
    plain = [w.lower().strip(".,?!:;[]()<>°'~-=#$") for w in words]
    out, at = [], 0
    for form in forms:
        own = form.lower().strip("'~-")
        hit = next((k for k in (at, at + 1) if k < len(words) and (plain[k].replace(":", "") == own or plain[k].replace(":", "").startswith(own) and own)), None)
        out.append(hit)
        at = at if hit is None else hit + 1
    return out


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def soft_align(forms: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([word_cursor(list(f if f is not None else []), list(w if w is not None else [])) for f, w in zip(forms, words, strict=True)])


def kids(rows: DataFrame, keys: list[str], order: str = "line") -> DataFrame:
    """Fills missing token ids from the last known one: prefix-(number + how many rows since). Rows before any known id stay null."""
    by = Window.partitionBy(*keys).orderBy(order)
    df = rows.withColumn("__known", F.last("kid", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("__run", F.sum(F.col("kid").isNotNull().cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    since = F.row_number().over(Window.partitionBy(*keys, "__run").orderBy(order)) - 1
    part = lambda k: F.regexp_extract("__known", r"^(.*)-(\d+)[^-]*$", k)
    df = df.withColumn("__since", since)
    return df.withColumn("kid", F.coalesce("kid", F.when(F.col("__known").isNotNull(), F.concat(part(1), F.lit("-"), (part(2).cast("long") + F.col("__since")).cast("string"))))).drop("__known", "__run", "__since")


def orphan_parents(rows: DataFrame, file: str) -> DataFrame:
    """Rows (file, token_id, form): the parents that sub-tokens name and that aren't there, their forms those of the sub-tokens together."""
    sub = rows.where(F.col("token_id").rlike(r"^\d+-\d+[A-Za-z]$")).withColumn("parent", F.regexp_replace("token_id", "[A-Za-z]$", ""))
    lost = sub.join(rows.select(file, F.col("token_id").alias("parent")).distinct(), [file, "parent"], "left_anti")
    return lost.groupBy(file, F.col("parent").alias("token_id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("token_id", "form"))), lambda x: x["form"]), "").alias("form"))
