"""Skew probe: the waterfall scan vs a plain per-key window when one key holds
a large share of the rows.

Builds items from lineitem (each row repeated ``REPEAT`` times with a
distinct id) where every returned line ('R') belongs to one hot key, runs
both plans to the noop sink with an event log in a fresh scratch folder, and
prints wall time plus the longest and median task of the heaviest stage.

Usage: python tools/skew_probe.py [sf_dir] [repeat]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from apportion.operators.allocate import waterfall  # noqa: E402
from apportion.session import JOB_CONF, ensure_checkpoint_dir  # noqa: E402
from apportion.sources.readers import scratch_path  # noqa: E402


def stage_stats(logdir: str, group: str) -> tuple[float, float, int]:
    import zstandard

    tasks: dict[int, list[int]] = {}
    stage_job: dict[int, str] = {}
    for f in glob.glob(os.path.join(logdir, "*", "events_*")) + glob.glob(os.path.join(logdir, "*.zstd")):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e.get("Stage IDs", []):
                    stage_job[s] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    heavy = max((s for s in tasks if stage_job.get(s) == group), key=lambda s: sum(tasks[s]))
    d = sorted(tasks[heavy])
    return d[-1] / 1000, d[len(d) // 2] / 1000, len(d)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    logdir = tempfile.mkdtemp(prefix="skew-probe-", dir="/tmp")
    b = (SparkSession.builder.master("local[8]").appName("skew-probe")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "32").config("spark.driver.memory", "16g")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)

    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    items = (li.select("l_orderkey", "l_returnflag", "l_shipdate", "l_linenumber", "l_extendedprice",
                       F.explode(F.sequence(F.lit(1), F.lit(repeat))).alias("rep"))
             .select(F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("k"),
                     "l_shipdate", F.monotonically_increasing_id().alias("id"),
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("amt")))
    # fixed input for both plans: parquet files in a scratch folder under the checkpoint location
    path = scratch_path(spark, "skew-probe-items")
    items.repartition(24).write.parquet(path)
    items = spark.read.parquet(path)
    n = items.count()
    hot = items.where("k = -1").count()
    totals = items.groupBy("k").agg((F.sum("amt") * F.lit(0.6)).cast("decimal(18,2)").alias("total"))
    order = [F.desc("l_shipdate"), F.desc("id")]

    def run(group: str, build) -> float:
        spark.sparkContext.setJobGroup(group, group)
        t0 = time.perf_counter()  # the scan stores its ranges when it is built
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    t_scan = run("scan", lambda: waterfall(items, totals, "k", "amt", order, "total"))
    w = Window.partitionBy("k").orderBy(*order)
    prev = F.coalesce(F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.lead("id").over(w).isNull()
    rem = F.greatest(F.coalesce(F.col("total"), F.lit(0)) - prev, F.lit(0))
    naive = items.join(totals, "k", "left").select("*", F.when(last, rem).otherwise(F.least("amt", rem)).alias("a"))
    t_win = run("window", lambda: naive)
    spark.stop()
    for name, t in (("scan", t_scan), ("window", t_win)):
        mx, med, nt = stage_stats(logdir, name)
        print(json.dumps({"plan": name, "rows": n, "hot_rows": hot, "wall_sec": round(t, 2),
                          "heaviest_stage_tasks": nt, "max_task_sec": mx, "median_task_sec": med}))


if __name__ == "__main__":
    main()
