"""Skew probe for formula joins: a target whose hot key holds a third of the rows.

6,000,000 items from lineitem (sf0.1 rows repeated 10 times; every returned
line gets key -1) take ``share = amt / sum(amt of the key)`` through a
``sum_of`` formula. Prints wall time and the longest/median task of the join
stage from an event log in a fresh scratch folder. Small AQE skew thresholds
stand in for cluster-size partitions.

Usage: python tools/skew_join_probe.py [sf_dir] [repeat]
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

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from apportion.operators.formula import add_result_columns, settle  # noqa: E402
from apportion.session import JOB_CONF, ensure_checkpoint_dir, ship_package  # noqa: E402
from apportion.sources.readers import scratch_path  # noqa: E402
from apportion.specs import Formula, Item, sum_of  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    logdir = tempfile.mkdtemp(prefix="skew-join-probe-", dir="/tmp")
    b = (SparkSession.builder.master("local[8]").appName("skew-join-probe")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "32").config("spark.driver.memory", "16g")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4MB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    # at cluster scale the one-row-per-key side is far above any broadcast limit
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")

    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    path = scratch_path(spark, "skew-join-items")
    (li.select("l_orderkey", "l_returnflag", "l_extendedprice",
               F.explode(F.sequence(F.lit(1), F.lit(repeat))).alias("rep"))
       .select(F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("k"),
               F.monotonically_increasing_id().alias("id"),
               F.col("l_extendedprice").cast("decimal(18,2)").alias("amt"))
       .repartition(24).write.parquet(path))
    items = add_result_columns(spark.read.parquet(path), {"share": "double"})
    totals = items.groupBy("k").agg(F.sum("amt").alias("tot"))
    f = Formula.of("share", "items", [Item("share", "amt / $t", (sum_of("t", "totals", "tot", on="k"),))])
    out = settle({"items": items, "totals": totals}, [f])["items"]
    spark.sparkContext.setJobGroup("formula", "formula")
    t0 = time.perf_counter()
    out.write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    check = out.agg(F.sum("share").alias("s"))
    check.collect()
    plan = check._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    skew_join = "SortMergeJoin(skew=true)" in plan
    spark.stop()

    import zstandard

    tasks: dict[int, list[int]] = {}
    stage_group: dict[int, str] = {}
    for fpath in glob.glob(os.path.join(logdir, "*", "events_*")):
        raw = open(fpath, "rb").read()
        if fpath.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = e.get("Properties", {}).get("spark.jobGroup.id")
            if e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    # the join stage: the formula job's stage with the most task time
    join_stage = max((s for s in tasks if stage_group.get(s) == "formula"), key=lambda s: sum(tasks[s]))
    d = sorted(tasks[join_stage])
    print(json.dumps({"wall_sec": round(wall, 2), "skew_join": skew_join, "join_stage_tasks": len(d),
                      "max_task_sec": d[-1] / 1000, "median_task_sec": d[len(d) // 2] / 1000}))


if __name__ == "__main__":
    main()
