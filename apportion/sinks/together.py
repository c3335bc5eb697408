"""Several data sets saved as one: all of a job's tables change, or none.

Each save writes its tables to folders of its own, and then one small
manifest that names the folder of every table. Readers follow the manifest of
the highest version, so what a job has written shows when its
manifest does, all at once; a job that fails before leaves the old state. The
manifest carries the job's id: a job that runs again after its manifest was written
changes nothing. Versions are created exclusively, so of two saves at the same
time one raises and can be run again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.plans.job import OLD_ID, DataSet, SettlementResult
from apportion.sinks.upsert import merge_changes, tag_changes
from apportion.sources.load import DATE

_NAME = re.compile(r"^[0-9]{8}\.json$")


class SaveConflict(RuntimeError):
    """Another job wrote the next version first."""


def _files(spark: SparkSession, root: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_manifests")
    return jvm, path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def manifests(spark: SparkSession, root: str) -> list[dict]:
    """All manifests, oldest first: version, job and the folder of each table."""
    _, folder, fs = _files(spark, root)
    if not fs.exists(folder):
        return []
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if _NAME.match(n))
    return [json.loads(spark.read.text(f"{root.rstrip('/')}/_manifests/{n}", wholetext=True).first().value) for n in names]


def _commit(spark: SparkSession, root: str, manifest: dict) -> None:
    """Write the manifest beside its place and move it there, unless that version exists."""
    jvm, folder, fs = _files(spark, root)
    fs.mkdirs(folder)
    place = jvm.org.apache.hadoop.fs.Path(folder, f"{manifest['version']:08d}.json")
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(json.dumps(manifest).encode())
    finally:
        out.close()
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(draft), fs.makeQualified(place), options)
    except Exception as wrong:
        fs.delete(draft, False)
        if fs.exists(place):
            raise SaveConflict(f"version {manifest['version']} of {root} exists") from wrong
        raise


def save_together(frames: Mapping[str, DataFrame], root: str, job: str) -> int:
    """Save all tables of a job; returns the version that shows them (that of the first run, if ``job`` was saved before).

    Tables not named here stay as they are. A frame may read the tables it
    replaces: its folder is new.
    """
    spark = next(iter(frames.values())).sparkSession
    known = manifests(spark, root)
    for m in known:
        if m["job"] == job:
            return m["version"]
    tables = dict(known[-1]["tables"]) if known else {}
    for name, df in frames.items():
        folder = f"{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{root.rstrip('/')}/{folder}")
        tables[name] = folder
    version = known[-1]["version"] + 1 if known else 1
    _commit(spark, root, {"version": version, "job": job, "tables": tables})
    return version


def read_saved(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame | None:
    """A table as the newest (or a given) version shows it; None if that version has no such table."""
    known = [m for m in manifests(spark, root) if version is None or m["version"] == version]
    folder = known[-1]["tables"].get(name) if known else None
    return None if folder is None else spark.read.parquet(f"{root.rstrip('/')}/{folder}")


def save_settled(result: SettlementResult, datasets: Sequence[DataSet], root: str, job: str) -> int:
    """Apply the changes of a settlement to its stored tables, all in one version.

    A table that is not stored yet begins with the inserts. Settled frames are
    kept persisted until the save is done, as a frame often feeds a later one.
    """
    by_name = {d.name: d for d in datasets}
    todo = [by_name[n] for n in result.changed if n in by_name and by_name[n].target is not None]
    kept = [result.frames[d.name].persist(StorageLevel.MEMORY_AND_DISK) for d in todo]
    try:
        tables = {}
        for d, frame in zip(todo, kept):
            dates = [f.out for f in d.fields if f.type == DATE]
            stored = read_saved(frame.sparkSession, root, d.target.table)
            if OLD_ID not in frame.columns:
                if stored is not None:
                    raise ValueError(f"data set {d.name!r} was loaded without its stored ids")
                frame = frame.withColumn(OLD_ID, F.lit(None).cast("string"))
            if stored is None:
                new = tag_changes(frame.where(f"{OLD_ID} IS NULL"), d.target.columns, d.target.pk, OLD_ID, dates, action="__action")
                tables[d.target.table] = new.drop("__action")
            else:
                tables[d.target.table] = merge_changes(stored, frame, d.target.columns, d.target.pk, OLD_ID, dates)
        return save_together(tables, root, job) if tables else 0
    finally:
        for df in kept:
            df.unpersist()
