"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so (after the first sentence end or line end past a minimum
size; where there is none up to a maximum size, after the first of some rare characters; and only
where there is none of these either at the maximum size), so equal passages give equal chunks wherever they stand. The
chunk text moves once: equal chunks are merged before the shuffle, and in the shuffle every digest
is verified to stand for one chunk only. A document is from then on the ordered list of its chunk
identifiers, its recipe; documents are equal when their recipes are equal, so long texts are never
moved or compared again.

Defined results: null text counts as empty; empty texts equal each other; of equal texts the row
with the largest id stays; repeated rows (same id and text) are returned as often as they come and
count as often; rows with a null id form groups too, and a null never beats an id. An empty table
gives no rows. Columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text, written

MIN_CHARS, MAX_CHARS = 1024, 8192
MAX_COLLISIONS = 10_000


def sha256_bytes(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def chunks(text: Column, least: int = MIN_CHARS, most: int = MAX_CHARS) -> Column:
    """The ordered chunks of a text; put together they are the text. An empty text has none."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most}}}?(?<=[.!?\n\x{{3002}}])|.{{{least},{most}}}?(?<=[0QZXqzx\x{{3001}}])|.{{1,{most}}}"), F.lit(0))


def colliding(texts: DataFrame, digest: Callable[[Column], Column], cut: Callable[[Column], Column]) -> list[bytes] | None:
    """The digests that stand for more than one chunk text, found by comparing the chunks themselves; None if they are too many to name."""
    each = texts.select(F.explode(cut(F.col("text"))).alias("chunk")).select(digest(F.col("chunk")).alias("digest"), "chunk")
    found = each.distinct().groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest").take(MAX_COLLISIONS + 1)
    if len(found) > MAX_COLLISIONS:
        return None
    return [bytes(r.digest) for r in found]


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256_bytes, cut: Callable[[Column], Column] = chunks) -> DataFrame:
    """Rows (doc_id, text, recipe): recipe is the ordered list of verified chunk identifiers.

    The identifier is the digest; a digest found to collide is followed by the chunk itself, and so
    is every digest where more than MAX_COLLISIONS do.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    bad = colliding(rows, digest, cut)
    name = digest
    if bad is None:
        name = lambda c: F.concat(digest(c), F.encode(c, "UTF-8"))
    elif bad:
        known = F.array(*[F.lit(bytearray(b)) for b in bad])
        name = lambda c: F.when(F.array_contains(known, digest(c)), F.concat(digest(c), F.encode(c, "UTF-8"))).otherwise(digest(c))
    return rows.withColumn("recipe", F.transform(cut(F.col("text")), name))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, doc_id, text, **how).select("doc_id", F.length("text").alias("n"), "recipe", F.sha2("text", 256).alias("text_sha256"))
    # By recipe and length, joined by recipe alone: the join then deals both sides anew, and a very
    # large group of copies can be split over many tasks, as its groups side is one row.
    groups = rows.groupBy("recipe", "n").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).drop("n")
    return rows.join(groups, "recipe").select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one row of each text.

    Of equal texts the row with the largest id stays, of repeated rows one. Rows without an id stay
    where no row with an id has their text, again one of each text. Ids may repeat with other texts.
    """
    found = written(exact_dedup(docs, doc_id, text, **how).select("doc_id", "keep_id", "kept", "text_sha256"), "exact")
    own = F.sha2(whole_text(text), 256)
    kept = found.where("kept").select(F.col("doc_id").alias("__kept"), F.col("text_sha256").alias("__sha"))
    out = docs.join(kept.distinct(), (docs[doc_id] == F.col("__kept")) & (own == F.col("__sha")), "left_semi")
    # the two rare cases cost a count of ids each, and a shuffle of texts only where they occur
    if not kept.groupBy("__kept", "__sha").count().where("count > 1").isEmpty():
        out = out.withColumn("__own", own).dropDuplicates([doc_id, "__own"]).drop("__own")
    if not found.where("doc_id is null").isEmpty():
        taken = found.where("keep_id is not null").select(F.col("text_sha256").alias("__sha"))
        loose = docs.where(F.col(doc_id).isNull()).withColumn("__own", own).dropDuplicates(["__own"])
        out = out.unionByName(loose.join(taken, F.col("__own") == F.col("__sha"), "left_anti").drop("__own"))
    return out


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
