"""A folder of transcripts kept in step: what is new or changed is processed, what has vanished is taken away.

A manifest holds, for every file, its size, its time of change and the digest of its content. Files
whose size and time are as in the manifest aren't opened; of the others only those whose digest
differs are processed. Results are partitioned by transcript, so partitions of changed and vanished
files are the only ones touched, and the log and error pages of their modules are made again from
the occurrences that are kept. The manifest is written last: a run that was broken off is done again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators import validation
from parlance.plans.process import process
from parlance.sources.config import load
from parlance.sources.files import read_units, there, transcript_id
from parlance.sources.modules import place
from parlance.sources.work import written

MANIFEST = "path string, transcript_id string, length long, modified timestamp, digest string"
KEPT = ("vert", "summary", "occurrences")


@dataclass(frozen=True)
class Changes:
    """What differs from the manifest: the files to process, ids of transcripts that are gone, how many files were opened; and the manifest as it should be."""

    paths: list[str]
    changed: list[str]
    vanished: list[str]
    opened: int
    manifest: DataFrame


def changes(spark: SparkSession, source: str, manifest: str) -> Changes:
    """Compare the files of a glob with a manifest. Contents are read of files whose size or time differ, and of no others."""
    old = spark.read.schema(MANIFEST).parquet(manifest) if there(spark, manifest) else spark.createDataFrame([], MANIFEST)
    if there(spark, source):
        # the content is no column of this plan, so it isn't read
        listed = spark.read.format("binaryFile").load(source).select("path", "length", F.col("modificationTime").alias("modified"))
    else:
        listed = old.select("path", "length", "modified").limit(0)
    was = old.select("path", F.col("length").alias("__length"), F.col("modified").alias("__modified"), "digest")
    # written, not cached: a cache would be found again by the next run, whose plan is the same
    both = written(listed.join(was, "path", "left").withColumn("transcript_id", transcript_id(F.col("path"))), "listed")
    same = F.col("length").eqNullSafe(F.col("__length")) & F.col("modified").eqNullSafe(F.col("__modified"))
    # a list of file names, which Spark's readers take from the driver
    suspects = [r.path for r in both.where(~same).select("path").collect()]
    if suspects:
        digests = spark.read.format("binaryFile").load([p.replace("{", r"\{").replace("[", r"\[") for p in suspects]).select("path", F.sha2("content", 256).alias("new"))
    else:
        digests = spark.createDataFrame([], "path string, new string")
    now = written(both.join(digests, "path", "left").select("path", "transcript_id", "length", "modified", F.coalesce("new", "digest").alias("digest"), (F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("digest"))).alias("changed")), "files")
    found = [(r.path, r.transcript_id) for r in now.where("changed").select("path", "transcript_id").collect()]
    gone = [r.transcript_id for r in old.select("transcript_id").distinct().join(now, "transcript_id", "left_anti").collect()]
    return Changes([p for p, _ in found], sorted({t for _, t in found}), sorted(gone), len(suspects), now.drop("changed"))


def without(spark: SparkSession, folder: str, column: str, values: list[str]) -> None:
    """Delete the partitions of these values."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values:
        fs, at = place(spark, f"{folder}/{column}={escaped(value)}")
        fs.delete(at, True)


def rewritten(df: DataFrame, path: str) -> None:
    """Write a table over the one that `df` may read: beside it, then in its place."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.new")
    fs, at = place(spark, path)
    fs.delete(at, True)
    fs.rename(place(spark, f"{path}.new")[1], at)


def reported(spark: SparkSession, path: str, modules: list[str]) -> None:
    """The log and error pages of these modules, from the occurrences kept; pages of a module without transcripts go."""
    for name in ("log", "errors"):
        without(spark, f"{path}/{name}", "module", modules)
    if not there(spark, f"{path}/occurrences/transcript_id=*"):
        return
    rows = spark.read.parquet(f"{path}/occurrences").where(F.col("module").isin(modules))
    said = rows.where("kind <> 'processed'")
    every = rows.where("kind = 'processed'").select("module", "code")
    write = lambda df, name: df.select("module", "text").write.mode("append").partitionBy("module").text(f"{path}/{name}")
    write(validation.log_pages(every, validation.totals(said)), "log")
    write(validation.error_pages(validation.records(said)), "errors")


def sync(spark: SparkSession, source: str, path: str, config: dict | None = None, module: Column | None = None) -> Changes:
    """Bring the results in `path` in step with the utterance tables of a glob. Returns what was done."""
    config = load() if config is None else config
    module = X.module_of(F.col("code"), "other") if module is None else module
    found = changes(spark, source, f"{path}/manifest")
    touched = found.changed + found.vanished
    if not touched:
        return found
    names = spark.createDataFrame([(t,) for t in touched], "code string").select(module.alias("module")).distinct()
    modules = sorted(r.module for r in names.collect())
    for name in KEPT:
        without(spark, f"{path}/{name}", "transcript_id", touched)
    if found.paths:
        units = read_units(spark, found.paths, config["ignored_tiers"], config["extracted_tiers"], config["translation_suffix"])
        got = process(units.drop("line", "duration"), config)
        marks = validation.shaped(got["units"].select(F.col("transcript_id").alias("code"), F.lit("processed").alias("kind"), F.lit(0).alias("n")).distinct().withColumn("module", module))
        rows = validation.occurrences(got["units"], got["tokens"], module).unionByName(marks)
        for name, df in (("vert", got["vert"]), ("summary", got["summary"]), ("occurrences", rows.withColumn("transcript_id", F.col("code")))):
            df.write.mode("append").partitionBy("transcript_id").parquet(f"{path}/{name}")
    reported(spark, path, modules)
    rewritten(found.manifest, f"{path}/manifest")
    return found
