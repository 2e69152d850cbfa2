"""Command line: python -m parlance.cli VERB INPUT OUTPUT [options]. Inputs are paths or globs; outputs are folders, a part for each transcript."""

from __future__ import annotations

import argparse
from itertools import combinations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators import alignment, formats, metadata, pages, patches, patching, validation, wip
from parlance.plans.process import process
from parlance.sources import config, files, modules
from parlance.streaming.sync import sync

KEYS = ["transcript_id", "tu_id"]


def vert_rows(spark: SparkSession, path: str):
    return files.read_vert(spark, path).withColumn("tu_id", F.col("tu_id").cast("long"))


#: The tables of a module, the columns that a collection has of them, and which hold several values.
TABLES = {"participants": metadata.PARTICIPANTS, "conversations": metadata.CONVERSATIONS}
SEVERAL = {"languages": ";", "type": ":"}


def ignored_pairs(spark: SparkSession, path: str | None, units):
    """The pairs of overlaps that an annotation file leaves out, in every transcript of `units`; None without a file."""
    pairs = sorted({pair for group in config.ignored(path) for pair in combinations(sorted(set(group)), 2)})
    if not pairs:
        return None
    # as many as an annotator has written down
    return units.select("transcript_id").distinct().join(F.broadcast(spark.createDataFrame(pairs, "u int, v int")))


def metadata_verbs(spark: SparkSession, args: argparse.Namespace) -> int:
    """The verbs of metadata tables. Returns how many issues were found."""
    if args.verb == "merge_metadata":
        for name, columns in TABLES.items():
            parts = [files.read_metadata(spark, f"{m}/metadata/{name}.tsv") for m in modules.listed(spark, args.input)]
            parts = [p.withColumn("__module", F.lit(k)) for k, p in enumerate(parts) if len(p.columns) > 2]
            if not parts:
                raise SystemExit(f"no module has {name}")
            got = metadata.merged(parts, [*columns], {"school-region": "birth-region"}, ("type", "birth-region"))
            modules.write_file(got, f"{args.output}/{name}.tsv", ["code"])
        return 0
    if args.verb == "translate_metadata":
        words = files.read_table(spark, args.translations)
        for name in TABLES:
            df = files.read_metadata(spark, f"{args.input}/{name}.tsv").na.fill("")
            own = sorted(c for c in df.columns if c != "line")
            # of the table's own columns, those that have translations
            columns = sorted(r[0] for r in words.where((F.col("table") == name) & F.col("column").isin(own)).select("column").distinct().collect())
            several = {c: sep for c, sep in SEVERAL.items() if c in columns}
            modules.write_file(metadata.translated(df, words, name, columns, several), f"{args.output}/{name}.tsv", ["line"])
            if columns:
                modules.write_file(metadata.left_untranslated(df, words, name, columns, several), f"{args.output}/{name}.untranslated.tsv", ["column", "value"])
        return 0
    found = modules.listed(spark, args.input)
    if not found:
        raise SystemExit("no module found")
    count = 0
    for module in found:
        if args.verb == "unknown_participants":
            modules.refresh_unknown(spark, module)
            continue
        tables = [files.read_metadata(spark, f"{module}/metadata/{name}.tsv") for name in ("conversations", "participants")]
        checks = metadata.module_checks(*tables, modules.spoken(spark, module)).cache()
        modules.write_file(checks, f"{args.output}/{module.rsplit('/', 1)[-1]}.tsv", ["problem", "conversation", "participant"])
        count += checks.count()
    return count


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Carries out a verb. Returns how many issues were found, where the verb looks for them."""
    if args.verb in ("merge_metadata", "translate_metadata", "check_participants", "unknown_participants"):
        return metadata_verbs(spark, args)
    settings = config.load(args.config)
    if args.threshold is not None:
        settings["duration_threshold"] = args.threshold
    if args.verb == "process":
        units = files.read_units(spark, args.input, settings["ignored_tiers"], settings["extracted_tiers"], settings["translation_suffix"])
        got = process(units.drop("line", "duration"), settings, ignored_pairs(spark, args.annotations, units))
        files.write_table(got["vert"].withColumns({"__t": F.col("tu_id").cast("long"), "__i": F.col("id").cast("int")}), f"{args.output}/vert", order=["__t", "__i"])
        files.write_texts(got["summary"].withColumnRenamed("json", "text"), f"{args.output}/summary")
        files.write_table(got["linear"], f"{args.output}/linear", order=["tu_id"])
        files.write_table(got["translations"].select("transcript_id", "tu_id", "speaker", "start", "end", "parent_tu_id", "text"), f"{args.output}/translations", order=["tu_id"])
    elif args.verb == "eaf2csv":
        files.write_table(files.read_eaf(spark, args.input).drop("old_id"), args.output, order=["tu_id"])
    elif args.verb == "csv2eaf":
        files.write_texts(formats.eaf(files.read_units(spark, args.input), args.media), args.output)
    elif args.verb == "vert2eaf":
        files.write_texts(formats.eaf(formats.rebuilt(vert_rows(spark, args.input), KEYS), args.media), args.output)
    elif args.verb == "conll2conllu":
        files.write_texts(formats.conllu(vert_rows(spark, args.input), KEYS), args.output, order=["tu_id"])
    elif args.verb == "vert2tei":
        about = {c: files.read_metadata(spark, f"{args.metadata}/{c}.tsv") if args.metadata else None for c in TABLES}
        layers = dict(x.split("=", 1) for x in (args.layers or "").split(",") if x)
        files.write_texts(formats.tei(vert_rows(spark, args.input), about["conversations"], participants=about["participants"], layers=layers), args.output)
    elif args.verb == "vert2chat":
        files.write_texts(formats.chat(vert_rows(spark, args.input)), args.output)
    elif args.verb == "csv2html":
        files.write_texts(pages.html_pages(files.read_units(spark, args.input)), args.output)
    elif args.verb == "validate":
        if not files.there(spark, args.input):
            raise SystemExit(f"{args.input}: the file can't be read")
        rows = files.read_vert(spark, args.input)
        # by name, as Spark's sources pass over files without a byte
        fs, at = modules.place(spark, args.input)
        listed = spark.createDataFrame([(f.getPath().getName(),) for f in fs.globStatus(at)], "name string").select(files.transcript_id(F.col("name")).alias("transcript_id")).distinct()
        bare = listed.join(rows.select("transcript_id").distinct(), "transcript_id", "left_anti")
        faults = bare.select("transcript_id", F.lit("").alias("token_id"), F.lit("error").alias("severity"), F.lit("the file is empty or has no rows").alias("check"))
        if "token_id" in rows.columns:
            faults = patches.checked(rows, "transcript_id").unionByName(faults)
        faults = faults.cache()
        files.write_table(faults, args.output, order=["token_id", "check"])
        return faults.where("severity = 'error'").count()
    elif args.verb == "align":
        pairs = alignment.file_pairs(alignment.timed_tokens(files.read_vert(spark, args.input)))
        rows = alignment.alignment_rows(pairs, ["base", "first", "second"], ids=("ids_a", "ids_b"))
        files.write_table(rows, f"{args.output}/tokens", by="base", order=["first", "second", "position"])
        files.write_table(alignment.error_rate(rows, ["base", "first", "second"]), f"{args.output}/rates", by="base", order=["first", "second"])
        shown = rows.select("base", "first", "second", "position", "match", F.col("id_a").alias("id_A"), F.col("a").alias("token_A"), F.col("id_b").alias("id_B"), F.col("b").alias("token_B"))
        files.write_table(shown, f"{args.output}/aligned", by="base", order=["first", "second", "position"])
    elif args.verb == "make_patch":
        lines = files.read_lines(spark, args.input).withColumn("transcript_id", F.regexp_replace("transcript_id", r"\.vert$", "")).cache()
        source, heads = patching.source_rows(lines)
        edited = files.read_table(spark, args.edited).withColumnRenamed("transcript_id", "file")
        rows = patching.patched(source, heads, edited).cache()
        old = lines.withColumnRenamed("transcript_id", "file").withColumn("line", F.col("line").cast("long") - 1)
        named = lambda df, column, end: df.select(F.concat("file", F.lit(end)).alias("transcript_id"), F.col(column).alias("text"))
        # a text's last line end is put there by the writer
        made = patching.unified(old, patching.new_lines(rows, heads)).withColumn("patch", F.regexp_replace("patch", "\n$", ""))
        files.write_texts(named(made, "patch", ".vert.tsv.patch"), f"{args.output}/patches")
        values = [F.coalesce(F.col(side)[c], F.lit("_")).alias(f"{side}_{c}") for side in ("old", "new") for c in pages.SHOWN]
        items = patching.recap_items(rows).select("file", "at", "token_id", "tu_id", "change", "notes", *values)
        files.write_texts(named(pages.recap_markdown(items, "file", "at", fields=True), "text", ".vert.tsv.recap.md"), f"{args.output}/recaps")
    elif args.verb == "sync":
        found = sync(spark, args.input, args.output, settings)
        print(f"{len(found.changed)} processed, {len(found.vanished)} taken away, {found.opened} opened")
    elif args.verb == "report":
        units = files.read_units(spark, args.input, settings["ignored_tiers"], settings["extracted_tiers"], settings["translation_suffix"])
        got = process(units.drop("line", "duration"), settings, ignored_pairs(spark, args.annotations, units))
        module = X.module_of(F.col("code"), "other")
        rows = validation.occurrences(got["units"], got["tokens"], module)
        every = got["units"].select(F.col("transcript_id").alias("code")).distinct().withColumn("module", module)
        log = validation.log_pages(every, validation.totals(rows)).cache()
        files.write_texts(log, f"{args.output}/log", by="module")
        files.write_texts(validation.log_overview(log).withColumn("module", F.lit("all")), f"{args.output}/overview", by="module")
        found = validation.records(rows).cache()
        files.write_texts(validation.error_pages(found), f"{args.output}/errors", by="module")
        files.write_texts(found.withColumnRenamed("json", "text"), f"{args.output}/records", by="module", order=["code", "place"])
        return found.count()
    elif args.verb == "conllu2wip":
        rows = wip.converted(files.read_conllu(spark, args.input).withColumnRenamed("transcript_id", "file")).withColumnRenamed("file", "transcript_id").cache()
        files.write_table(rows.select("transcript_id", *wip.FIELDS, "sort"), f"{args.output}/wip", order=["sort"], sep=",", drop=["sort"])
        files.write_table(rows.where("note <> ''").select("transcript_id", "token_id", "note"), f"{args.output}/notes", order=["token_id"])
    elif args.verb == "linear":
        got = formats.linear(vert_rows(spark, args.input), KEYS)
        for kind in ("jefferson", "orthographic"):
            text = F.concat("speaker", F.lit("\t"), kind)
            files.write_texts(got.where(f"{kind} is not null").withColumn("text", text), f"{args.output}/{kind}", order=["first_line"])
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("verb", choices=["process", "eaf2csv", "csv2eaf", "vert2eaf", "conll2conllu", "vert2tei", "vert2chat", "csv2html", "validate", "align", "linear", "merge_metadata", "translate_metadata", "check_participants", "unknown_participants", "make_patch", "conllu2wip", "report", "sync"])
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--config", help="a module's YAML settings")
    parser.add_argument("--threshold", type=float, help="seconds below which an overlap is short")
    parser.add_argument("--media", default="", help="the recording that ELAN files name")
    parser.add_argument("--annotations", help="a YAML file whose `ignore` lists groups of units that don't overlap")
    parser.add_argument("--metadata", help="the folder of conversations.tsv and participants.tsv that a TEI header is made from")
    parser.add_argument("--layers", help="columns of spans and their names in TEI: column=name,column=name")
    parser.add_argument("--edited", help="the edited tables that a patch is made from")
    parser.add_argument("--translations", help="a table of table, column, en, it")
    return run(SparkSession.builder.appName("parlance").getOrCreate(), parser.parse_args(argv))


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
