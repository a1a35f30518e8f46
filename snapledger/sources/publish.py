"""Versioned publish with optimistic concurrency, on any Hadoop-compatible file system.

Layout under a table root::

    data/<uuid>/            immutable Parquet directories (written once), a merge's open rows by hash bucket of the key
    commits/<N>.json        pointer: {"open": {bucket: "data/<uuid>/..."} or "data/<uuid>", "closed": ["data/<uuid>", ...],
                            "parent": N-1, "run_ts": last run, "runs": {run time: digest of its snapshot}}

A version is visible once its pointer exists.  A pointer is written aside, whole,
and then renamed to its name *without overwriting*: a crash in between leaves only
a stray temporary file, and of two writers that race from the same baseline one
gets ``commits/N+1`` and the other ``StaleBaseline`` (and removes its data
directory).  This needs a store whose rename refuses an existing target, as HDFS
does; on an object store, put a commit service or conditional writes in front.
A pointer that can't be read (left by an older writer's crash) counts as not there.

Every applied run is recorded with a digest of its snapshot.  The same run again is
a no-op; a run time that is not after the last one, or the same time with other
rows, raises ``GateError``: no snapshot is dropped in silence.  A merge compares keys and hashes
first; only the buckets that hold a new, changed or retired key are read whole, joined and written again,
the pointer keeps naming the folders of the others.  The rows it closed are *appended* as a new closed
directory, so no job ever reads and overwrites the same path.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators import checks as ck
from snapledger.operators import geo, rings, scd2


BUCKETS = 64               # of a table's open rows, fixed when it is created; see ``merge_and_commit``


class StaleBaseline(RuntimeError):
    """Someone else committed since the baseline this writer started from."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def _exists(spark, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def latest_version(spark: SparkSession, root: str) -> int | None:
    fs, p, jvm = _fs(spark, f"{root.rstrip('/')}/commits")
    if not fs.exists(p):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    versions = sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)
    return next((v for v in versions if _readable(spark, root, v)), None)


def _readable(spark: SparkSession, root: str, version: int) -> bool:
    try:
        return "open" in read_pointer(spark, root, version)
    except ValueError:                       # empty or cut off
        return False


def read_pointer(spark: SparkSession, root: str, version: int) -> dict:
    fs, p, jvm = _fs(spark, f"{root.rstrip('/')}/commits/{version}.json")
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = "".join(iter(reader.readLine, None))
    finally:
        stream.close()
    return json.loads(text)


def create_whole(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file in one step: written aside, then renamed; False if ``path`` is there already."""
    fs, p, jvm = _fs(spark, path)
    if fs.exists(p):
        return False
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(aside, p, none)         # refuses an existing target
    except Exception as e:  # noqa: BLE001 -- FileAlreadyExistsException surfaces as Py4JJavaError
        fs.delete(aside, False)
        if "AlreadyExists" in str(e) or fs.exists(p):
            return False
        raise
    return True


def _create_pointer(spark: SparkSession, root: str, version: int, text: str) -> bool:
    path = f"{root.rstrip('/')}/commits/{version}.json"
    if _exists(spark, path) and not _readable(spark, root, version):
        fs, p, _ = _fs(spark, path)
        fs.delete(p, False)                  # what a crash left
    return create_whole(spark, path, text)


def read_version(spark: SparkSession, root: str, version: int, part: str = "all") -> DataFrame:
    """History at a version: open rows, closed rows, or both."""
    ptr = read_pointer(spark, root, version)
    dirs = (_open_dirs(ptr) if part in ("all", "open") else []) + (ptr["closed"] if part in ("all", "closed") else [])
    return _read(spark, root, dirs)


def _read(spark: SparkSession, root: str, dirs: list[str]) -> DataFrame:
    """Folders that the pointer names, at any depth; what their names say (open, bucket) is no column."""
    return spark.read.option("recursiveFileLookup", True).parquet(*[f"{root.rstrip('/')}/{d}" for d in dirs])


def _open_dirs(ptr: dict, buckets: list[int] | None = None) -> list[str]:
    """Folders of a version's open rows: all, or those of some buckets."""
    held = ptr["open"]
    if isinstance(held, str):
        return [held]
    return sorted(d for b, d in held.items() if buckets is None or (b != "none" and int(b) in buckets))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _write(df: DataFrame, root: str, key: str | None) -> str:
    rel = f"data/{uuid.uuid4().hex}"
    if key:
        df = df.repartitionByRange(key).sortWithinPartitions(key)
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{rel}")
    return rel


def commit_version(spark: SparkSession, root: str, open_rows: DataFrame, closed_rows: DataFrame | None,
                   baseline: int | None, key: str | None = None, run_ts: str | None = None, closed_all: bool = False) -> int:
    """Write the new open part (+ newly closed rows; all closed rows if ``closed_all``) and publish version baseline+1 atomically."""
    prev = read_pointer(spark, root, baseline) if baseline is not None else {"closed": []}
    latest = latest_version(spark, root)
    if latest != baseline:
        raise StaleBaseline(f"baseline {baseline} is stale; latest is {latest}")
    open_dir = _write(open_rows, root, key)
    closed = [] if closed_all else list(prev["closed"])
    if closed_rows is not None:
        closed.append(_write(closed_rows, root, key))
    version = 0 if baseline is None else baseline + 1
    ptr = json.dumps({"open": open_dir, "closed": closed, "parent": baseline,
                      "run_ts": run_ts if run_ts is not None else prev.get("run_ts"), "runs": prev.get("runs", {})})
    if not _create_pointer(spark, root, version, ptr):
        for rel in {open_dir, *closed} - set(prev["closed"]):
            _drop(spark, root, rel)
        raise StaleBaseline(f"version {version} was committed by another writer")
    return version


def _drop(spark: SparkSession, root: str, rel: str) -> None:
    """Remove a data directory that this writer wrote and no pointer names."""
    fs, p, _ = _fs(spark, f"{root.rstrip('/')}/{rel}")
    fs.delete(p, True)


def _write_versions(versions: DataFrame, root: str, key: str | None, buckets: int = 1) -> tuple[str, dict[str, str]]:
    """One write job: closed rows, and open rows by bucket, in sub-directories of a fresh data directory.

    Returns that directory and the folder of each bucket that holds open rows.  A bucket goes through one task,
    its rows in order of the key.
    """
    spark = versions.sparkSession
    rel = f"data/{uuid.uuid4().hex}"
    base = f"{root.rstrip('/')}/{rel}"
    out = versions.withColumn("_open", F.col("is_current")).withColumn("_bucket", bucket_of(key, buckets) if key else F.lit(0))
    if key:
        out = out.repartition("_bucket").sortWithinPartitions("_open", "_bucket", key)       # the partitioned writer needs its columns first
    out.write.mode("errorifexists").partitionBy("_open", "_bucket").parquet(base)
    fs, p, jvm = _fs(spark, f"{base}/_open=true")
    held = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return rel, {n.removeprefix("_bucket="): f"{rel}/_open=true/{n}" for n in sorted(held) if n.startswith("_bucket=")}


def _publish_pointer(spark: SparkSession, root: str, written: tuple[str, dict[str, str]] | None, prev: dict, baseline: int | None, run_ts: str | None,
                     digest: str | None = None, buckets: int = 1, touched: list[int] | None = None, empty: DataFrame | None = None) -> int:
    """Publish version baseline + 1; without ``written`` the data of the baseline stays (a run that changed nothing).

    ``touched`` are the buckets that were written again; all, if None.
    """
    closed, held = list(prev["closed"]), prev.get("open")
    rel = written[0] if written else None
    if written:
        if _exists(spark, f"{root.rstrip('/')}/{rel}/_open=false"):
            closed.append(f"{rel}/_open=false")
        kept = held if isinstance(held, dict) and touched is not None else {}
        held = {b: d for b, d in kept.items() if b != "none" and int(b) not in touched} | written[1]
        if not held and empty is not None:                  # every key retired: an empty open part keeps the columns
            empty.write.parquet(f"{root.rstrip('/')}/{rel}/_open=none")
            held = {"none": f"{rel}/_open=none"}
    version = 0 if baseline is None else baseline + 1
    runs = dict(prev.get("runs", {}))
    if run_ts is not None:
        runs[run_ts] = digest
    ptr = json.dumps({"open": held, "closed": closed, "parent": baseline, "buckets": buckets,
                      "run_ts": run_ts if run_ts is not None else prev.get("run_ts"), "runs": runs})
    if not _create_pointer(spark, root, version, ptr):
        if rel:
            _drop(spark, root, rel)
        raise StaleBaseline(f"version {version} was committed by another writer")
    return version


def canonical_ts(ts: str) -> str:
    """'YYYY-MM-DD HH:MM:SS[.ffffff]' of a run time in UTC, so that run times compare as text; one without an offset is UTC."""
    try:
        at = datetime.fromisoformat(ts)
    except ValueError:
        at = datetime.strptime(ts, "%Y-%m-%d %H:%M:%S" if ":" in ts else "%Y-%m-%d")
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc)
    return at.replace(tzinfo=None).isoformat(sep=" ")


def snapshot_digest(snapshot: DataFrame, key: str) -> str:
    """Order-free digest of a snapshot's keys and content hashes: one aggregate over two columns."""
    h = F.xxhash64(F.col(key), F.col("attr_hash"))
    r = snapshot.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h)).alias("y")).first()
    return f"{r.n}-{r.x}-{r.y}"


def applied_runs(spark: SparkSession, root: str) -> dict[str, str | None]:
    """Run time -> snapshot digest of every run in the table."""
    v = latest_version(spark, root)
    return {} if v is None else read_pointer(spark, root, v).get("runs", {})


def checkout(spark: SparkSession, root: str) -> tuple[DataFrame | None, int | None]:
    """(history at the latest version, that version) -- the baseline for the next commit."""
    v = latest_version(spark, root)
    return (None, None) if v is None else (read_version(spark, root, v), v)


def archive_bytes(spark: SparkSession, root: str) -> int:
    """Size of the files of the latest version, open and closed; 0 without one."""
    v = latest_version(spark, root)
    if v is None:
        return 0
    ptr, total = read_pointer(spark, root, v), 0
    for d in [*_open_dirs(ptr), *ptr["closed"]]:
        fs, p, _ = _fs(spark, f"{root.rstrip('/')}/{d}")
        total += fs.getContentSummary(p).getLength()
    return total


def retire_raw(spark: SparkSession, raw_path: str | None, keep_raw: bool) -> None:
    """Delete a run's raw input directory -- only ever called after its commit succeeded."""
    if raw_path and not keep_raw:
        fs, p, _ = _fs(spark, raw_path)
        if fs.exists(p):
            fs.delete(p, True)


def merge_and_commit(spark: SparkSession, root: str, snapshot: DataFrame, ts: str, key: str,
                     create: bool = True, raw_path: str | None = None,
                     keep_raw: bool = True, buckets: int = BUCKETS, status: DataFrame | None = None) -> tuple[int, bool]:
    """SCD2-merge ``snapshot`` at run time ``ts`` into the table at ``root``: (version, changed).

    With ``keep_raw=False`` the raw input directory ``raw_path`` is deleted after the
    run is safely in the table (committed, or found to be a no-op); never before.
    ``buckets`` counts for a new table only: as many as files of a fair size hold its open rows.
    ``status`` is ``scd2.classify`` of the open rows and the snapshot where the caller has it (written) already.
    """
    result = _merge_and_commit(spark, root, snapshot, ts, key, create, buckets, status)
    retire_raw(spark, raw_path, keep_raw)
    return result


def _merge_and_commit(spark: SparkSession, root: str, snapshot: DataFrame, ts: str, key: str,
                      create: bool, buckets: int, status: DataFrame | None) -> tuple[int, bool]:
    """Keys and hashes are compared once; the buckets of the keys that changed are merged and written, a failure
    before the pointer leaves the previous version as the visible one."""
    from snapledger.operators import gates

    ts = canonical_ts(ts)
    digest = snapshot_digest(snapshot, key)
    v = latest_version(spark, root)
    if v is None:
        if not create:
            raise FileNotFoundError(root)
        versions = scd2.merge_versions(scd2.empty_history(snapshot), snapshot, ts, key)
        written = _write_versions(versions, root, key, buckets)
        return _publish_pointer(spark, root, written, {"closed": []}, None, ts, digest, buckets, empty=scd2.empty_history(snapshot)), True
    prev = read_pointer(spark, root, v)
    runs = prev.get("runs", {})
    if ts in runs and runs[ts] in (None, digest):
        return v, False          # this run is already in the table: a replay is a no-op
    if ts in runs:
        raise gates.GateError(f"run {ts} is in the table with other rows")
    last = prev.get("run_ts")
    if last is not None and ts <= canonical_ts(last):
        raise gates.GateError(f"run {ts} is not after the last run {last}: a late snapshot can't be merged")
    open_hist = read_version(spark, root, v, "open")
    gates.assert_ts_after(open_hist, ts)
    if latest_version(spark, root) != v:
        raise StaleBaseline(f"baseline {v} is stale")
    if status is None:
        status = scd2.classify(open_hist.select(key, "attr_hash"), snapshot.select(key, "attr_hash"), key)
    whole = isinstance(prev["open"], str)                    # written by ``commit_version``: bucketed from now on
    n = buckets if whole else prev["buckets"]
    changed = status.where(F.col("status") != "unchanged")
    touched = sorted(r["_b"] for r in changed.select(bucket_of(key, n).alias("_b")).distinct().collect())      # at most n numbers
    if not touched:
        return _publish_pointer(spark, root, None, prev, v, ts, digest, prev.get("buckets", 1)), False
    if not whole and len(touched) < n:
        dirs = _open_dirs(prev, touched)
        open_hist = _read(spark, root, dirs) if dirs else open_hist.limit(0)
        snapshot = snapshot.where(bucket_of(key, n).isin(touched))
    versions = scd2.merge_versions(open_hist, snapshot, ts, key)
    written = _write_versions(versions, root, key, n)
    return _publish_pointer(spark, root, written, prev, v, ts, digest, n, None if whole else touched, scd2.empty_history(snapshot)), True


def build_current_artifact(current: DataFrame, key: str, geom: str | None = "geom",
                           tolerance: float = 1e-5) -> DataFrame:
    """Current rows without the change hash, geometry snapped to the tolerance grid, centroids added."""
    df = current.drop("attr_hash")
    if geom:
        # the centroid struct is one column, split afterwards: evaluated once per row
        df = (df.withColumn("_told", rings.told(F.col(geom))).withColumn("_centroid", rings.centroid(F.col("_told"), F.col(geom)))
              .withColumn(geom, geo.quantise(F.col(geom), tolerance))
              .withColumn("centroid_lon", F.col("_centroid.lon"))
              .withColumn("centroid_lat", F.col("_centroid.lat")).drop("_told", "_centroid"))
    return df


def write_artifact(artifact: DataFrame, path: str, key: str) -> None:
    """Key-clustered output: range partitions + sorted files give tight min/max stats for pruning."""
    artifact.repartitionByRange(key).sortWithinPartitions(key).write.mode("errorifexists").parquet(path)


def push(spark: SparkSession, tables: dict[str, DataFrame], checks: list[ck.Check], publish_fn,
         force: bool = False):
    """Gate on error-severity checks over exactly what ships; then publish (force skips the gate)."""
    if not force:
        ck.gate(tables, checks)
    return publish_fn()
