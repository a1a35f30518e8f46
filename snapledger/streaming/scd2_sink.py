"""Snapshots announced by manifests, merged into the versioned history by a streaming query.

A snapshot is many files and must be merged whole, so the stream does not read
snapshot rows directly: writers first write a complete snapshot directory, then
drop a small JSON *manifest* ``{"run_ts": ..., "path": ...}`` into a watched
folder.  ``readStream.json`` picks manifests up; ``foreachBatch`` merges every
announced snapshot that the table lacks in run-time order through
``publish.merge_and_commit`` (a distributed read + merge per snapshot).

The file source hands manifests out by modification time, which says nothing about run
times.  So a micro-batch only wakes the sink: it looks at *all* manifests in the folder
and merges those not in the table yet, oldest run first.  A manifest that comes after a
later run was merged, or a second one of a run with other rows, can't be merged any more: it is set aside as a row
of ``refused`` and the stream goes on, so one late snapshot neither stops the others nor is lost.  Manifests are
written aside and renamed, so a running stream never sees half of one.

The table pointer records the applied runs, so a micro-batch replayed after a failure
commits nothing: the sink is idempotent and exactly-once in effect.
``trigger(availableNow=True)`` drains what is there and stops (daily cadence);
a processing-time trigger makes it continuous.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from snapledger.operators.gates import GateError
from snapledger.sources import publish

MANIFEST_SCHEMA = "run_ts string, path string"
REFUSED = "_refused"           # sub-folder of the manifests, which the stream doesn't read


def announce(spark: SparkSession, manifest_dir: str, run_ts: str, snapshot_path: str) -> None:
    """Publish a manifest for a snapshot directory that is already completely written."""
    name = publish.canonical_ts(run_ts).replace(" ", "T").replace(":", "")
    text = json.dumps({"run_ts": run_ts, "path": snapshot_path}) + "\n"
    if not publish.create_whole(spark, f"{manifest_dir.rstrip('/')}/{name}.json", text):
        raise FileExistsError(f"run {run_ts} is announced already")


def manifest_stream(spark: SparkSession, manifest_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(MANIFEST_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(manifest_dir)


def merge_batch(manifest_dir: str, table_root: str, key: str, drop: tuple[str, ...] = ()):
    """foreachBatch function: merge every announced snapshot that the table lacks, oldest run first."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # manifests are one tiny row per snapshot, never data rows
        there = spark.read.schema(MANIFEST_SCHEMA).json(manifest_dir).unionByName(batch.select("run_ts", "path")).distinct()
        done = publish.applied_runs(spark, table_root)
        todo = sorted((publish.canonical_ts(m.run_ts), m.path) for m in there.collect())
        aside = {(publish.canonical_ts(m.run_ts), m.path) for m in refused(spark, manifest_dir).collect()}
        for ts, path in todo:
            if ts not in done and (ts, path) not in aside:
                try:
                    publish.merge_and_commit(spark, table_root, spark.read.parquet(path).drop(*drop), ts, key)
                except GateError as why:
                    text = json.dumps({"run_ts": ts, "path": path, "status": "refused", "reason": str(why)}) + "\n"
                    name = ts.replace(" ", "T").replace(":", "")
                    publish.create_whole(spark, f"{manifest_dir.rstrip('/')}/{REFUSED}/{name}-{uuid.uuid4().hex[:8]}.json", text)
    return fn


def refused(spark: SparkSession, manifest_dir: str) -> DataFrame:
    """(run_ts, path, status, reason) of the manifests that came too late to be merged."""
    folder = f"{manifest_dir.rstrip('/')}/{REFUSED}"
    schema = MANIFEST_SCHEMA + ", status string, reason string"
    fs, p, _ = publish._fs(spark, folder)
    return spark.read.schema(schema).json(folder) if fs.exists(p) else spark.createDataFrame([], schema)


def run(spark: SparkSession, manifest_dir: str, table_root: str, key: str, checkpoint_location: str,
        drop: tuple[str, ...] = (), available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start (and with ``available_now`` wait for) the streaming merge; returns the query."""
    w = (manifest_stream(spark, manifest_dir, max_files_per_trigger).writeStream
         .foreachBatch(merge_batch(manifest_dir, table_root, key, drop))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
