"""Modules of a corpus: folders with metadata/ and tsv/, their paths, their metadata and their summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.fields import missing
from parlance.operators.metadata import first_of, last_by_code, unknown_participant
from parlance.sources.files import read_metadata, read_table, read_vert, speakers, there


def place(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path on it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def discovered(spark: SparkSession, root: str, skip: tuple[str, ...] = ()) -> list[str]:
    """The modules inside a folder, by name: those with metadata/conversations.tsv and a tsv/*.vert.tsv. Hidden folders and those named in `skip` are none."""
    fs, at = place(spark, f"{root.rstrip('/')}/*/metadata/conversations.tsv")
    folders = [f.getPath().getParent().getParent() for f in fs.globStatus(at) or []]
    named = sorted((f.getName(), f.toString()) for f in folders)
    return [path for name, path in named if name not in skip and not name.startswith(".") and there(spark, f"{path}/tsv/*.vert.tsv")]


def listed(spark: SparkSession, given: str) -> list[str]:
    """Module folders from a list with commas, in that order; one folder without metadata/ stands for the modules inside it."""
    paths = [p.strip().rstrip("/") for p in given.split(",") if p.strip()]
    return discovered(spark, paths[0]) if len(paths) == 1 and not there(spark, f"{paths[0]}/metadata") else paths


def spoken(spark: SparkSession, module: str) -> DataFrame:
    """Rows (transcript_id, speaker) of a module's token tables; a transcript in which nobody speaks has one of an empty speaker."""
    rows = read_vert(spark, f"{module}/tsv/*.vert.tsv")
    files = rows.select("transcript_id").distinct().withColumn("speaker", F.lit(""))
    said = speakers(rows)
    return said.unionByName(files.join(said, "transcript_id", "left_anti"))


def of_conversation(spark: SparkSession, module: str, code: str) -> tuple[DataFrame, DataFrame]:
    """A conversation's row, the first of that code, and the rows of its participants, of equal codes the last.

    A conversation that isn't there, or lists nobody, gives all participants.
    """
    every = read_metadata(spark, f"{module}/metadata/conversations.tsv")
    own = first_of(every.where(F.col("code") == code), ["code"], [F.col("line")])
    people = read_metadata(spark, f"{module}/metadata/participants.tsv", unique=True)
    if "participants" not in own.columns:
        return own, people
    # a row at most, so its codes are what one conversation lists
    codes = own.where(~missing(F.col("participants"))).select(F.explode(F.split("participants", ";")).alias("code")).distinct()
    return own, people if codes.isEmpty() else people.join(codes, "code", "left_semi")


def summary(spark: SparkSession, path: str) -> DataFrame | None:
    """The summaries of a file that holds a list of them, of equal transcripts the last; None where there is no file."""
    if not there(spark, path):
        return None
    rows = spark.read.json(path, multiLine=True).withColumn("line", F.monotonically_increasing_id())
    return last_by_code(rows, key="transcript").drop("line")


def headers(spark: SparkSession, path: str) -> list[str]:
    """The column names of a delimited file."""
    return [c for c in read_table(spark, path).columns if c not in ("transcript_id", "line")]


def readable(spark: SparkSession, path: str) -> str | None:
    """Why a table of edits can't be checked at all: it isn't there, or has no rows. None where it can."""
    if not there(spark, path):
        return "the file can't be read"
    return "the file is empty or has no rows" if read_table(spark, path, ",").isEmpty() else None


def is_file(spark: SparkSession, path: str) -> bool:
    fs, at = place(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isFile()


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, at = place(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def below_wip(path: str) -> tuple[list[str], list[str], str]:
    """What stands before wip/ in a path, what after it, and the file's name without its ending."""
    parts = path.split("/")
    stem = parts[-1].rsplit(".", 1)[0]
    at = parts.index("wip") if "wip" in parts else len(parts)
    return parts[:at], parts[at + 1 :], stem


def patch_path(edited: str) -> str:
    """wip/MODULE/NAME.csv to patches/MODULE/NAME.vert.tsv.patch; beside the file where it isn't below wip/."""
    root, below, stem = below_wip(edited)
    folder = [*root, "patches", below[0]] if len(below) > 1 else edited.split("/")[:-1]
    return "/".join([*folder, f"{stem}.vert.tsv.patch"])


def source_path(edited: str, root: str | None = None) -> str:
    """The token table that wip/MODULE/NAME.csv edits: MODULE/tsv/NAME.vert.tsv in `root`, by default in the folder around that of wip/."""
    before, below, stem = below_wip(edited)
    if len(below) < 2:
        raise ValueError(f"{edited} isn't in a module's folder below wip/")
    around = root.rstrip("/").split("/") if root is not None else before[:-1] if before and before[-1] not in ("", "..") else [*before, ".."]
    return "/".join([*around, below[0], "tsv", f"{stem}.vert.tsv"])


def file_urls(module: Column, code: Column, base: str, branch: str = "dev") -> tuple[Column, Column]:
    """Where a site shows a transcript's token table and its ELAN file."""
    page = lambda folder, end: F.concat(F.lit(f"{base.rstrip('/')}/"), module, F.lit(f"/blob/{branch}/{folder}/"), code, F.lit(end))
    return page("tsv", ".vert.tsv"), page("eaf", ".eaf")


def write_file(df: DataFrame, path: str, order: list[str], sep: str = "\t") -> None:
    """One delimited file with a header, in order; null is `_`. For metadata, whose format is one file with a row for each person or conversation.

    A file that was there is put aside first and deleted last, so one of the two is always there.
    The columns of `order` that are named line or begin with two underscores aren't written. The file
    is made beside its place and moved there, so that a table can be written over the one it was read from.
    """
    spark = df.sparkSession
    shown = [c for c in df.columns if not (c in order and (c == "line" or c.startswith("__")))]
    new = f"{path}.{uuid.uuid4().hex}"
    rows = df.repartition(1).sortWithinPartitions(*[F.col(f"`{c}`") for c in order]).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in shown])
    rows.write.csv(new, sep=sep, header=True, quote='"', escape='"', nullValue="_", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    fs, at = place(spark, path)
    folder = place(spark, new)[1]
    part = fs.globStatus(place(spark, f"{new}/part-*")[1])[0].getPath()
    # the old file stays beside the new one until that is in its place
    old = place(spark, f"{path}.old-{uuid.uuid4().hex}")[1]
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"can't put {path} aside")
    if not fs.rename(part, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"can't write {path}")
    if had:
        fs.delete(old, False)
    fs.delete(folder, True)


def refresh_unknown(spark: SparkSession, module: str) -> None:
    """Write the column unknown-participant of a module's conversations.tsv anew: at its place, or last where there was none."""
    path = f"{module}/metadata/conversations.tsv"
    rows = read_metadata(spark, path).na.fill("")
    names = [c for c in rows.columns if c != "line"]
    names += ["unknown-participant"] * ("unknown-participant" not in names)
    write_file(unknown_participant(rows, spoken(spark, module)).select("line", *[F.col(f"`{c}`") for c in names]), path, ["line"])
