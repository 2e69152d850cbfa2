"""Overlapping speech: interval join, pruning, nudged boundaries, maximal cliques, matching with annotated spans.

Units are rows (transcript_id, tu_id, start, end, ...). Edges are rows (transcript_id, u, v, start,
end, duration) with u < v.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.sources.work import written

T = "transcript_id"


def slot_width(start: Column, end: Column, key: str = T) -> Column:
    """A width of time slots that a transcript's own units give: four times their mean length. Its units then lie in at most a quarter more slots than there are units, and a slot holds few of them."""
    return F.greatest(4 * F.avg(F.greatest(end - start, F.lit(0))).over(Window.partitionBy(key)), F.lit(1e-3))


def slots(start: Column, end: Column, width: Column) -> Column:
    """The slots that an interval lies in; the one of its start at least."""
    first = F.floor(start / width)
    return F.sequence(first, F.greatest(F.floor(end / width), first))


def overlap_join(units: DataFrame, width: float | None = None, key: str = T) -> DataFrame:
    """All pairs of units of a transcript that overlap for longer than nothing.

    Units are dealt by the time slots they lie in, so that a very long transcript is many small
    joins; a pair is found in the slot where the later of the two starts. Without a `width` of
    slots, every transcript has its own.
    """
    own = units.select(key, "tu_id", "start", "end").withColumn("__w", F.lit(float(width)) if width else slot_width(F.col("start"), F.col("end"), key))
    own = own.withColumn("slot", F.explode(slots(F.col("start"), F.col("end"), F.col("__w"))))
    left = own.select(key, "slot", "__w", F.col("tu_id").alias("u"), F.col("start").alias("us"), F.col("end").alias("ue"))
    right = own.select(key, "slot", F.col("tu_id").alias("v"), F.col("start").alias("vs"), F.col("end").alias("ve"))
    pairs = left.join(right, [key, "slot"]).where("u < v and ue > vs and ve > us").where(F.col("slot") == F.floor(F.greatest("us", "vs") / F.col("__w")))
    return pairs.select(key, "u", "v", F.greatest("us", "vs").alias("start"), F.least("ue", "ve").alias("end")).withColumn("duration", F.col("end") - F.col("start"))


def without_units(edges: DataFrame, units: DataFrame, key: str = T) -> DataFrame:
    """Edges without those that touch one of `units` (key, tu_id), such as units of non-verbal events alone."""
    own = units.select(key, "tu_id").distinct()
    return edges.join(own.withColumnRenamed("tu_id", "u"), [key, "u"], "left_anti").join(own.withColumnRenamed("tu_id", "v"), [key, "v"], "left_anti").select(*edges.columns)


def ignored_pairs(groups: DataFrame, ids: str = "ids", key: str = T) -> DataFrame:
    """Pairs (u, v) of all units named together: `ids` is text such as `15 10`."""
    every = groups.select(key, F.transform(F.split(F.trim(ids), r"\s+"), lambda x: x.cast("long")).alias("ids"))
    one = every.select(key, "ids", F.explode("ids").alias("a")).select(key, "a", F.explode("ids").alias("b"))
    return one.where("a < b").select(key, F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def without_pairs(edges: DataFrame, pairs: DataFrame, key: str = T) -> DataFrame:
    own = pairs.select(key, F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    return edges.join(own, [key, "u", "v"], "left_anti").select(*edges.columns)


def short_edges(edges: DataFrame, units: DataFrame, threshold: float, key: str = T) -> DataFrame:
    """Edges shorter than the threshold of two units without annotated overlaps. Units have n_spans."""
    plain = units.where("n_spans = 0").select(key, "tu_id")
    short = edges.where(F.col("duration") < threshold)
    return short.join(plain.withColumnRenamed("tu_id", "u"), [key, "u"], "left_semi").join(plain.withColumnRenamed("tu_id", "v"), [key, "v"], "left_semi").select(*edges.columns)


def nudged(units: DataFrame, short: DataFrame, key: str = T) -> DataFrame:
    """Units with boundaries moved by half of every short overlap: the end of the lower id, the start of the higher. moved counts them."""
    sides = short.select(key, F.col("u").alias("tu_id"), (F.col("duration") / 2).alias("off"), F.lit(0).alias("on")).unionByName(short.select(key, F.col("v").alias("tu_id"), F.lit(0).alias("off"), (F.col("duration") / 2).alias("on")))
    moves = sides.groupBy(key, "tu_id").agg(F.sum("off").alias("off"), F.sum("on").alias("on"), F.count("*").alias("moved"))
    out = units.join(moves, [key, "tu_id"], "left")
    none = F.lit(0)
    return out.withColumns({"start": F.col("start") + F.coalesce("on", none), "end": F.col("end") - F.coalesce("off", none), "moved": F.coalesce("moved", none.cast("long"))}).drop("on", "off")


def maximal_cliques(nodes: dict[int, set[int]]) -> list[list[int]]:
    """Maximal cliques of two nodes and more, by size and then members. Iterative, with pivots."""
    found, work = [], [(frozenset(), set(nodes), set())]
    while work:
        clique, candidates, done = work.pop()
        if not candidates:
            if not done and len(clique) > 1:
                found.append(sorted(clique))
            continue
        pivot = max(candidates | done, key=lambda n: (len(nodes[n] & candidates), -n))
        for n in sorted(candidates - nodes[pivot]):
            work.append((clique | {n}, candidates & nodes[n], done & nodes[n]))
            candidates, done = candidates - {n}, done | {n}
    return sorted(found, key=lambda c: (len(c), c))


def with_islands(edges: DataFrame, key: str = T) -> DataFrame:
    """Adds `island`: the stretch of time without a break that an edge's overlap lies in.

    Units of a clique overlap all at once, so no clique has edges of two islands, nor could one be
    made larger by an edge of another.
    """
    by = Window.partitionBy(key).orderBy("start", "end")
    past = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    return edges.withColumn("__breaks", F.coalesce(F.col("start") >= past, F.lit(False)).cast("int")).withColumn("island", F.sum("__breaks").over(by)).drop("__breaks")


def cliques(edges: DataFrame, key: str = T) -> DataFrame:
    """Rows (key, event, members): the maximal cliques of each transcript's graph, numbered by size and members. A group is an island of a transcript; without start and end of edges, a transcript."""
    kind = edges.schema[key].dataType.simpleString()

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes: dict[int, set[int]] = {}
        for u, v in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
            nodes.setdefault(u, set()).add(v)
            nodes.setdefault(v, set()).add(u)
        return pd.DataFrame([(pdf[key].iloc[0], c) for c in maximal_cliques(nodes)], columns=[key, "members"])

    own = with_islands(edges, key) if {"start", "end"} <= set(edges.columns) else edges.withColumn("island", F.lit(0))
    # where an island is one edge, that is its clique
    sized = own.withColumn("__n", F.count("*").over(Window.partitionBy(key, "island")))
    alone = sized.where("__n = 1").select(key, F.array(F.least("u", "v").cast("long"), F.greatest("u", "v").cast("long")).alias("members"))
    rest = sized.where("__n > 1").select(key, "island", F.col("u").cast("long"), F.col("v").cast("long")).groupBy(key, "island").applyInPandas(work, f"{key} {kind}, members array<bigint>")
    event = F.row_number().over(Window.partitionBy(key).orderBy(F.size("members"), "members")) - 1
    return alone.unionByName(rest).select(key, event.alias("event"), "members")


def interval_cliques(units: DataFrame, key: str = T) -> DataFrame:
    """Rows (key, at, members): maximal cliques where no single edge was taken out, by a sweep.

    They are the units that are active at a start which an end follows before the next start. Starts
    meet units in the time slot of the start.
    """
    own = units.where("end > start").select(key, "tu_id", "start", "end").withColumn("__w", slot_width(F.col("start"), F.col("end"), key))
    starts = own.select(key, F.col("start").alias("at"), "__w").distinct()
    starts = starts.withColumn("until", F.lead("at").over(Window.partitionBy(key).orderBy("at"))).withColumn("slot", F.floor(F.col("at") / F.col("__w"))).drop("__w")
    each = own.withColumn("slot", F.explode(slots(F.col("start"), F.col("end"), F.col("__w")))).drop("__w")
    active = starts.join(each, [key, "slot"]).where("start <= at and end > at")
    got = active.groupBy(key, "at", "until").agg(F.array_sort(F.collect_set("tu_id")).alias("members"), F.min("end").alias("first_end"))
    return got.where("size(members) > 1 and (until is null or first_end <= until)").select(key, "at", "members")


def events(found: DataFrame, units: DataFrame, key: str = T) -> DataFrame:
    """Rows (key, event, tu_id, os, oe, nvb): the members of each clique, with the time all share. Units have start, end, any_nvb."""
    each = found.select(key, "event", F.explode("members").alias("tu_id")).join(units.select(key, F.col("tu_id").cast("long").alias("tu_id"), "start", "end", "any_nvb"), [key, "tu_id"])
    times = each.groupBy(key, "event").agg(F.max("start").alias("os"), F.min("end").alias("oe"), F.bool_or("any_nvb").alias("nvb"))
    return each.select(key, "event", "tu_id").join(times, [key, "event"])


def removable(threshold: float, nvb_participates: bool) -> Column:
    return (F.col("oe") - F.col("os") < threshold) | (F.col("nvb") & F.lit(not nvb_participates))


def judged(units: DataFrame, members: DataFrame, threshold: float = 0.0, nvb_participates: bool = False, key: str = T) -> DataFrame:
    """Rows (key, tu_id, n_spans, n_events, n_removable, outcome, warning, error). Units have n_spans.

    outcome: matched, trimmed (matched without the removable events), unknown (spans stand for `?`), none.
    """
    per = members.groupBy(key, "tu_id").agg(F.count("*").alias("n_events"), F.count_if(removable(threshold, nvb_participates)).alias("n_removable"))
    df = units.select(key, F.col("tu_id").cast("long").alias("tu_id"), F.col("n_spans").cast("long").alias("n_spans")).join(per, [key, "tu_id"], "left").fillna(0, ["n_events", "n_removable"])
    n, m, r = F.col("n_spans"), F.col("n_events"), F.col("n_removable")
    outcome = F.when(n == m, "matched").when(n == 0, "none").when((m > n) & (r == m - n), "trimmed").otherwise("unknown")
    warning = F.when((n == m), None).when(((n == 0) & (r >= m)) | ((n > 0) & (m > n) & (r == m - n)), "MISMATCHING_OVERLAPS")
    error = F.when(n == m, None).when((n == 0) & (r < m), "OVERLAPS:MISSING_ANNOTATION").when((n > 0) & (m == 0), "OVERLAPS:MISSING_TIME").when(outcome == "unknown", "MISMATCHING_OVERLAPS")
    return df.withColumns({"outcome": outcome, "warning": warning, "error": error})


def matched(verdicts: DataFrame, members: DataFrame, threshold: float = 0.0, nvb_participates: bool = False, key: str = T) -> DataFrame:
    """Rows (key, tu_id, span_id, event): the event of each annotated span, in order of time; `?` where it is unknown."""
    spans = verdicts.where("n_spans > 0").select(key, "tu_id", "outcome", F.explode(F.sequence(F.lit(0), F.col("n_spans").cast("int") - 1)).alias("span_id"))
    usable = members.join(verdicts.select(key, "tu_id", "outcome"), [key, "tu_id"]).where((F.col("outcome") == "matched") | ((F.col("outcome") == "trimmed") & ~removable(threshold, nvb_participates)))
    placed = usable.withColumn("span_id", F.row_number().over(Window.partitionBy(key, "tu_id").orderBy("os", "event")) - 1).select(key, "tu_id", "span_id", F.col("event").cast("string").alias("event"))
    known = spans.where("outcome in ('matched', 'trimmed')").drop("outcome").join(placed, [key, "tu_id", "span_id"])
    return known.unionByName(spans.where("outcome = 'unknown'").select(key, "tu_id", "span_id", F.lit("?").alias("event")))


def durations(verdicts: DataFrame, members: DataFrame, key: str = T) -> DataFrame:
    """Rows (key, tu_id, partners, duration) for units whose spans and events don't agree; partners joined by +."""
    wrong = verdicts.where("(outcome = 'none' or outcome = 'unknown') and n_events > 0").select(key, "tu_id")
    mates = members.select(key, "event", F.col("tu_id").alias("mate"))
    each = members.join(wrong, [key, "tu_id"], "left_semi").join(mates, [key, "event"]).where("mate <> tu_id")
    partners = F.array_join(F.transform(F.sort_array(F.collect_list("mate")), lambda x: x.cast("string")), "+")
    return each.groupBy(key, "tu_id", "event", "os", "oe").agg(partners.alias("partners")).select(key, "tu_id", "partners", (F.col("oe") - F.col("os")).alias("duration"))


def resolve(units: DataFrame, threshold: float = 0.1, nvb_participates: bool = False, ignore: DataFrame | None = None, width: float | None = None, key: str = T) -> dict[str, DataFrame]:
    """The whole chain: units (nudged), members of events, verdicts, matches, durations. Units have start, end, n_spans, all_nvb, any_nvb."""
    edges = overlap_join(units, width, key)
    if not nvb_participates:
        edges = without_units(edges, units.where("all_nvb"), key)
    if ignore is not None:
        edges = without_pairs(edges, ignore, key)
    # What several results need is written: a grouped function's output isn't reused by the planner.
    edges = written(edges, "edges")
    short = short_edges(edges, units, threshold, key)
    moved = written(nudged(units, short, key), "nudged")
    members = written(events(cliques(without_pairs(edges, short, key), key), moved, key), "events")
    verdicts = judged(moved, members, threshold, nvb_participates, key)
    return {"units": moved, "members": members, "verdicts": verdicts, "matches": matched(verdicts, members, threshold, nvb_participates, key), "durations": durations(verdicts, members, key)}
