"""Registered query: the order-book snapshots streamed through the SCD2 sink."""

from __future__ import annotations

from snapledger.plans import orderbook as ob

from snapledger.plans.registry import register
from snapledger.session import scratch_path
from snapledger.sources import publish
from snapledger.streaming import scd2_sink


@register("stream_scd2", f"{ob.history_ctes()} SELECT * FROM hist")
def q_stream_scd2(spark, d):
    """Write each snapshot, announce them newest first, stream the manifests into a fresh table."""
    base = scratch_path(spark, "stream-scd2")
    manifests, root, cp = f"{base}/manifests", f"{base}/table", f"{base}/_checkpoint"
    for i, (snap, ts) in reversed(list(enumerate(zip(ob.snapshots(spark, d), ob.RUN_TIMES), start=1))):
        path = f"{base}/incoming/run={i}"
        snap.write.mode("errorifexists").parquet(path)
        scd2_sink.announce(spark, manifests, ts, path)
    scd2_sink.run(spark, manifests, root, ob.KEY, cp, max_files_per_trigger=1)
    hist, _ = publish.checkout(spark, root)
    return hist.select(*ob.COLUMNS, "valid_from", "valid_to", "is_current")
