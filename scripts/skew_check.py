"""Skew check: one person holding a third of all spells.

Remaps a third of the residence rows of the test tables to one person, runs
``merge_spells`` and, for comparison, a plain per-person window version, with
Spark's event log written to a fresh scratch folder. Prints, per job, the
slowest task and the median task of its largest stage.

usage: python scripts/skew_check.py [sf_dir] [copies]

``copies`` repeats every residence row that many times, shifted by 500 days
per copy, so the hot person holds millions of spells.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cohortwise.functions.study import DEFAULT_WINDOW  # noqa: E402
from cohortwise.operators.spells import merge_spells  # noqa: E402
from cohortwise.sources.fixtures import Fixtures  # noqa: E402
from cohortwise.sources.tables import ParquetTables  # noqa: E402


def naive_islands(rows, window):
    w = Window.partitionBy("person_id").orderBy("active_from", "active_to")
    prev = F.lag("active_to").over(w)
    t = rows.select("person_id", "active_from", "active_to").withColumn(
        "opens", F.when(prev.isNull() | (F.date_diff("active_from", prev) >= window.gap_days), 1).otherwise(0)
    ).withColumn("island", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return t.groupBy("person_id", "island").agg(F.min("active_from").alias("s"), F.max("active_to").alias("e"))


def stage_stats(log_dir: str, job_group: str):
    tasks: dict[int, list[float]] = {}
    stage_job: dict[int, str] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    mine = {s: t for s, t in tasks.items() if stage_job.get(s) == job_group and len(t) > 1}
    worst = max(mine.items(), key=lambda kv: max(kv[1]))
    return max(worst[1]), statistics.median(worst[1]), len(worst[1])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.adaptive.enabled", "false")  # keep the raw partitioning visible
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    res = Fixtures(ParquetTables(spark, sf_dir)).residence
    hot = res.withColumn("person_id", F.when(F.col("person_id") % 3 == 0, F.lit(1)).otherwise(F.col("person_id")))
    hot = hot.withColumn("active_to", F.coalesce("active_to", F.lit("9999-01-01").cast("date")))
    if copies > 1:
        k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k")
        hot = hot.select("*", k).select(
            "person_id",
            F.date_add("active_from", F.col("k") * 500).alias("active_from"),
            F.when(F.col("active_to") >= F.lit("9000-01-01").cast("date"), F.col("active_to"))
            .otherwise(F.date_add("active_to", F.col("k") * 500))
            .alias("active_to"),
        )
    out = {}
    for name, df in (("merge_spells", merge_spells(hot, DEFAULT_WINDOW)), ("naive_window", naive_islands(hot, DEFAULT_WINDOW))):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        out[name] = {"seconds": round(time.time() - t0, 2)}
    spark.stop()
    for name in out:
        mx, med, n = stage_stats(log_dir, name)
        out[name].update({"slowest_task_ms": mx, "median_task_ms": med, "tasks": n})
    print(json.dumps({"hot_share": "1/3 of spells on one person", "copies": copies, "log_dir": log_dir, **out}))


if __name__ == "__main__":
    main()
