"""Measure how the median-gap work spreads over tasks when one repository holds a third of the rows.

Input is derived from the supplied ``lineitem`` table (every row is used): a third of the rows belong
to one repository, the rest to 50 others. The same median-gap computation runs twice:

* naive: ``lag`` over ``Window.partitionBy(repository)`` + ``percentile`` per repository;
* repolens: ``lag_within`` + ``exact_quantile_by`` (range-sorted segments).

Spark's event log (written to a fresh scratch folder) gives the shuffle records read by every task;
the script prints, per variant, the largest number of records any single task read and the total.
Usage: python scripts/skew_probe.py [sf_dir] [shuffle_partitions]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = sys.argv[2] if len(sys.argv) > 2 else "32"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    from pyspark.sql import Window, functions as F
    from repolens.session import get_spark
    from repolens.operators.aggregates import exact_quantile_by
    from repolens.operators.windows import lag_within
    spark = get_spark("local[8]", shuffle_partitions=int(parts), extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    repo = F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot/repo")).otherwise(
        F.concat(F.lit("r/"), (F.col("l_orderkey") % 50).cast("string")))
    ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber").cast("long"))
    base = li.select(repo.alias("repository"), ts.alias("closed_at"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))

    sc = spark.sparkContext
    sc.setJobGroup("naive", "naive")
    w = Window.partitionBy("repository").orderBy(F.col("closed_at").asc_nulls_last())
    naive = (base.withColumn("prev", F.lag("closed_at").over(w)).where(F.col("prev").isNotNull())
                 .select("repository", (F.timestamp_diff("SECOND", F.col("prev"), F.col("closed_at")) / 86400.0)
                         .alias("d"))
                 .groupBy("repository").agg(F.percentile("d", 0.5).alias("m")))
    want = {r[0]: r[1] for r in naive.collect()}

    sc.setJobGroup("repolens", "repolens")
    lagged = lag_within(base, ["repository"], "closed_at", "prev", tiebreak=["id"])
    gaps = (lagged.where(F.col("prev").isNotNull())
                  .select("repository", (F.timestamp_diff("SECOND", F.col("prev"), F.col("closed_at")) / 86400.0)
                          .alias("d"), "id"))
    got = {r[0]: r[1] for r in exact_quantile_by(gaps, ["repository"], "d", 0.5, tiebreak=["id"]).collect()}
    spark.stop()

    stage_group, task_reads = {}, defaultdict(list)
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    task_reads[ev["Stage ID"]].append(m.get("Total Records Read", 0))
    summary = {}
    for sid, reads in task_reads.items():
        g = stage_group.get(sid)
        if g and sum(reads):
            s = summary.setdefault(g, {"max_task_records": 0, "total_records": 0, "stages": []})
            s["max_task_records"] = max(s["max_task_records"], max(reads))
            s["total_records"] += sum(reads)
            s["stages"].append([sid, len(reads), max(reads), sum(reads)])
    same = want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-9 for k in want)
    print(json.dumps({"hot_share": "1/3", "shuffle_partitions": parts,
                      "medians_equal": same, "tasks": summary, "event_log": log_dir}))


if __name__ == "__main__":
    main()
