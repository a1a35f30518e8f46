"""Generic check forms: one passing and one failing input each, statuses, gate, samples."""

import pytest
from pyspark.sql import functions as F

from snapledger.operators import checks as ck


@pytest.fixture(scope="module")
def t(spark):
    h = spark.createDataFrame(
        [("k1", "h1", "2024-01-01", "2025-01-01", False), ("k1", "h2", "2025-01-01", None, True),
         ("k2", "h3", "2024-01-01", None, True), ("k3", "h4", "2024-01-01", "2024-06-01", False),
         ("k3", "h4", "2024-03-01", None, True), ("k4", "h5", "2024-01-01", None, True),
         ("k4", "h6", "2024-05-01", None, True)],
        "key string, attr_hash string, vf string, vt string, is_current boolean"
    ).select("key", "attr_hash", F.col("vf").cast("timestamp_ntz").alias("valid_from"),
             F.col("vt").cast("timestamp_ntz").alias("valid_to"), "is_current")
    c = spark.createDataFrame([("k1", 10.0, 4.0, 6.0, "A", "x"), ("k2", 5.0, 5.0, 1.0, "B", None),
                               ("k3", None, 1.0, 1.0, "Z", "y"), ("k4", -1.0, 0.0, 0.0, None, "")],
                              "key string, total double, a double, b double, cat string, name string")
    look = spark.createDataFrame([("A",), ("B",)], "v string")
    return {"history": h, "current": c, "lookup": look, "artifact": c.drop("name")}


def cases():
    return [
    (ck.unique("uniq", "history", ["key"], where=F.col("is_current")), 1),
    (ck.intervals_disjoint("disjoint", "history", ["key"]), 2),
    (ck.no_consecutive_duplicates("consecutive", "history", ["key"]), 1),
    (ck.not_null("nn", "current", ["name"], blank=True), 2),
    (ck.between("btw", "current", F.col("total"), 0, 100), 1),
    (ck.sums_to("sums", "current", F.col("total"), [F.col("a"), F.col("b")]), 3),
    (ck.iff("xor", "current", F.col("a") > 0, F.col("b") > 0), 0),
    (ck.in_set("known", "current", ["A", "B"], F.col("cat")), 1),
    (ck.share_at_least("share", "current", F.col("total") > 0, 0.75), 1),
    (ck.share_at_least("share_ok", "current", F.col("total") > 0, 0.5), 0),
    (ck.count_between("cnt", "current", 1, 3), 1),
    (ck.count_at_least("cnt2", "current", 4), 0),
    (ck.fresh_within("fresh", "history", "valid_from", F.lit("2024-05-05").cast("timestamp_ntz"), "7 DAYS"), 0),
    (ck.fresh_within("stale", "history", "valid_from", F.lit("2026-01-01").cast("timestamp_ntz"), "7 DAYS"), 1),
    (ck.same_count("same", "current", "artifact"), 0),
    (ck.no_column("nocol", "artifact", "name"), 0),
    (ck.no_column("nocol_bad", "current", "name"), 1),
    (ck.lookup_complete("lookup", "current", F.col("cat"), lambda t: t["lookup"]), 2),
    (ck.row_preserving("preserve", "current", "history"), 3),
    (ck.joined("join", "current", "artifact", ["key"], F.col("a") != F.col("b"), {"a": F.col("total")}, {"b": F.col("total")}), 0),
    (ck.joined("join_bad", "current", "artifact", ["key"], F.col("positive"), {"positive": F.col("total") > 0}, {}), 2),
    ]


@pytest.mark.parametrize("i", range(20))
def test_generic_form(t, i):
    check, expected = cases()[i]
    r = ck.run_all(t, [check]).first()
    assert r.violations == expected
    assert r.status == ("pass" if expected <= check.allowance else "fail")


def test_fused_suite_in_order_with_statuses(t):
    suite = [c for c, _ in cases()] + [ck.row("warned", "current", F.col("total") < 0, severity="warn"),
                                     ck.row("allowed", "current", F.col("total") < 0, allowance=1)]
    rows = ck.run_all(t, suite).orderBy("ord").collect()
    assert [r.name for r in rows] == [c.name for c in suite]
    st = {r.name: r.status for r in rows}
    assert st["warned"] == "warn" and st["allowed"] == "pass" and st["uniq"] == "fail"
    assert ck.run_all(t, suite, error_only=True).filter("name = 'warned'").count() == 0


def test_report_samples_only_on_breach(t):
    rep = {d["name"]: d for d in ck.report(t, [ck.unique("uniq", "history", ["key"], where=F.col("is_current")),
                                               ck.row("ok", "current", F.lit(False), sample_cols=["key"])])}
    assert rep["uniq"]["samples"] == [{"key": "k4", "n": 2}]
    assert rep["ok"]["samples"] is None


def test_gate(t):
    with pytest.raises(ck.ChecksFailed):
        ck.gate(t, [ck.row("neg", "current", F.col("total") < 0)])
    ck.gate(t, [ck.row("neg", "current", F.col("total") < 0, severity="warn")])
