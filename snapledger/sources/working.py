"""Working copies of a published history: pull, push, and the preconditions that keep one from overwriting the other.

A working copy is a folder with ``history`` (Parquet) and, once it was pulled or pushed, ``lineage.json``: the version of the
archive that it stands for.  A copy without lineage was born here.  ``push`` commits only if the archive still has that
version (or none, for a copy born here), after the error checks hold on exactly what ships; the archive goes first, the
derived artifact second.  ``pull`` does not overwrite a copy born here.  ``force`` skips these guards, never the order.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from snapledger.operators import checks as ck
from snapledger.operators import scd2
from snapledger.sources import publish


class LocalCopy(RuntimeError):
    """The working copy was born here: a pull would overwrite what is published nowhere."""


def lineage(spark: SparkSession, work: str) -> int | None:
    """The archive's version that the working copy stands for; None if it was born here."""
    fs, p, jvm = publish._fs(spark, f"{work.rstrip('/')}/lineage.json")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return json.loads("".join(iter(reader.readLine, None)))["version"]
    finally:
        stream.close()


def _set_lineage(spark: SparkSession, work: str, version: int | None) -> None:
    path = f"{work.rstrip('/')}/lineage.json"
    fs, p, _ = publish._fs(spark, path)
    if fs.exists(p):
        fs.delete(p, False)
    if version is not None:
        publish.create_whole(spark, path, json.dumps({"version": version}))


def history(spark: SparkSession, work: str) -> DataFrame | None:
    """The working copy's rows; None if there is no copy."""
    path = f"{work.rstrip('/')}/history"
    return spark.read.parquet(path) if publish._exists(spark, path) else None


def replace(spark: SparkSession, work: str, rows: DataFrame) -> None:
    """Put ``rows`` in the place of the working copy's: written aside first, so they may derive from it."""
    base = work.rstrip("/")
    aside = f"{base}/_new-{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    fs, new, jvm = publish._fs(spark, aside)
    old = jvm.org.apache.hadoop.fs.Path(f"{base}/history")
    if fs.exists(old):
        fs.delete(old, True)
    fs.rename(new, old)


def pull(spark: SparkSession, archive: str, work: str, force: bool = False) -> int | None:
    """Bring the archive's latest version into the working copy: that version, or None if nothing is published.

    An empty archive changes no rows and clears the lineage, so that the next push creates it.  A copy born here
    raises ``LocalCopy`` unless ``force``.
    """
    latest = publish.latest_version(spark, archive)
    if latest is None:
        _set_lineage(spark, work, None)
        return None
    if not force and history(spark, work) is not None and lineage(spark, work) is None:
        raise LocalCopy(f"{work} was born here; pull with force to overwrite it")
    _set_lineage(spark, work, None)                          # a crash in between leaves a copy that asks before it is overwritten
    replace(spark, work, publish.read_version(spark, archive, latest))
    _set_lineage(spark, work, latest)
    return latest


def push(spark: SparkSession, work: str, archive: str, artifact: str, key: str, checks: Sequence[ck.Check] = (),
         tables: Callable[[DataFrame], dict[str, DataFrame]] | None = None, geom: str | None = None, force: bool = False) -> int:
    """Publish the working copy as the archive's next version and its current rows as ``artifact/<version>``: the version.

    Raises ``StaleBaseline`` if the archive isn't at the copy's version any more (or exists, for a copy born here), and
    ``checks.ChecksFailed`` if an error check fails on the copy's tables; both leave archive and artifact as they are.
    """
    rows = history(spark, work)
    if rows is None:
        raise FileNotFoundError(f"{work}/history")
    own, latest = lineage(spark, work), publish.latest_version(spark, archive)
    if own != latest and not force:
        raise publish.StaleBaseline(f"the copy stands for version {own}, the archive is at {latest}")
    if checks and not force:
        ck.gate(tables(rows) if tables else {"history": rows, "current": scd2.current(rows)}, list(checks))
    version = publish.commit_version(spark, archive, rows.where("is_current"), rows.where("NOT is_current"), latest, key, closed_all=True)
    publish.write_artifact(publish.build_current_artifact(scd2.current(rows), key, geom), f"{artifact.rstrip('/')}/{version}", key)
    _set_lineage(spark, work, version)
    return version
