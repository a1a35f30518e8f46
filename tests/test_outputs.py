"""Small outputs: audit totals and exit code, cards, examples, evidence."""

from pyspark.sql import functions as F

from snapledger.operators import checks as ck
from snapledger.operators import link, names, rules


def test_audit_lists_what_did_not_pass(spark):
    t = {"t": spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")}
    suite = [ck.row("ok", "t", F.col("a") < 0), ck.row("warned", "t", F.col("b").isNull(), severity="warn", sample_cols=["a"])]
    outcomes, total, code = ck.audit(t, suite)
    assert [o["name"] for o in outcomes] == ["warned"] and outcomes[0]["samples"] == [{"a": 2}]
    assert total == {"pass": 1, "warn": 1, "fail": 0} and code == 0
    outcomes, total, code = ck.audit(t, [*suite, ck.row("failed", "t", F.col("a") > 1)])
    assert total == {"pass": 1, "warn": 1, "fail": 1} and code == 1
    assert {r.status: r.checks for r in ck.totals(ck.run_all(t, suite)).collect()} == {"pass": 1, "warn": 1, "fail": 0}


def test_cards(spark):
    trail = spark.createDataFrame([("An exempt muni home", 3), ("PO box in Girdwood", 9)], "mail_goes_to string, n long")
    held = spark.createDataFrame([(2, 10.0, True), (3, 30.0, True), (5, 500.0, True), (9, 1.0, False)], "n_homes long, total_value double, primary_found boolean")
    got = {r.card: r.value for r in link.cards(trail, held).collect()}
    assert got == {"exempt_share": 0.25, "verified_2nd_plus": 3.0, "third_plus": 2.0, "median_portfolio": 30.0}
    none = {r.card: r.value for r in link.cards(trail.where("false"), held.where("false")).collect()}
    assert none == {"exempt_share": 0.0, "verified_2nd_plus": 0.0, "third_plus": 0.0, "median_portfolio": None}


def test_truncation_examples_and_traps(spark):
    full = "A" * 30
    rows = [(f"{full}", full, None, None), (f"{full} B", full, "B", None), ("SHORT", "SHORT", None, None), ("B" * 30, "B" * 30, None, None)]
    df = spark.createDataFrame(rows, "owner_name string, owner_line_1 string, owner_line_2 string, owner_line_3 string")
    assert [r[0] for r in names.truncation_examples(df).collect()] == [full, "B" * 30]
    got = {r.trap: (r.ambiguous_parcels, r.example) for r in names.traps(spark.createDataFrame(
        [("X CO\\TTES",), ("A CO\\TTES",), ("SMITH REV TR",), ("SMITH TRUST TR",), (None,)], "owner_name string")).collect()}
    assert got["backslash for hyphen or slash"] == (2, "A CO\\TTES") and got["placeholder, no owner on file"] == (0, None)
    assert got["trust abbreviated, TRUST token absent"][1] == "SMITH REV TR"


def test_evidence(spark):
    base = next(iter(rules.OWNER_IDENTIFYING_BASES))
    rows = [("A", base + " - LAND", None), ("A", base, None), ("B", None, base), (None, base, None), ("C", "NEVER SEEN", None), ("D", None, None)]
    df = spark.createDataFrame(rows, "owner_name string, exemption_1_type string, exemption_2_type string")
    got = {r.base: tuple(r)[1:] for r in rules.evidence(df).collect()}
    assert got[base] == (f"owner → {rules.OWNER_IDENTIFYING_BASES[base]}", 4, 2, "A", 2, 0.5) and got["NEVER SEEN"] == ("unknown", 1, 1, "C", 1, 1.0)
