"""Islands of time and slots give what whole transcripts give."""

import random

from parlance.operators import overlaps
from pyspark.sql import functions as F


def test_islands_and_slots(spark):
    rng = random.Random(8)
    rows = []
    for t in ("a", "b", "c"):
        for i in range(60):
            s = rng.choice([rng.randint(0, 900), 10 * rng.randint(0, 20)])
            rows.append((t, i, float(s), float(s + rng.choice([0, 5, 12, 40, 300 if i % 20 == 0 else 20]))))
    units = spark.createDataFrame(rows, "transcript_id string, tu_id long, start double, end double")
    edges = overlaps.overlap_join(units)
    got = {(r.transcript_id, r.u, r.v) for r in edges.collect()}
    assert got == {(t, i, j) for t, i, s, e in rows for t2, j, s2, e2 in rows if t == t2 and i < j and e > s2 and e2 > s}
    assert got == {(r.transcript_id, r.u, r.v) for r in overlaps.overlap_join(units, 7).collect()} and edges.count() == len(got)
    # some edges go, as short ones do
    left = edges.where(F.pmod(F.xxhash64("transcript_id", "u", "v"), F.lit(4)) > 0).cache()
    by_island = [tuple(r) for r in overlaps.cliques(left).orderBy("transcript_id", "event").collect()]
    whole = [tuple(r) for r in overlaps.cliques(left.drop("start", "end")).orderBy("transcript_id", "event").collect()]
    assert by_island == whole and len(whole) > 50 and overlaps.with_islands(left).select("transcript_id", "island").distinct().count() > 6
    # the sweep leaves out units of no length
    longer = units.where("end > start")
    sweep = {(r.transcript_id, tuple(r.members)) for r in overlaps.interval_cliques(units).collect()}
    assert sweep == {(r.transcript_id, tuple(r.members)) for r in overlaps.cliques(overlaps.overlap_join(longer)).collect()}
