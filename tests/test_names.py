"""Owner-name cleaner golden fixture and contract."""

import pytest
from pyspark.sql import functions as F

from snapledger.functions.text import clean_owner_name
from snapledger.operators import checks as ck
from snapledger.operators import names

FIXTURE = [
    ("care-of percent", "BAILEY FAMILY LTD PARTNERSHIP % ESKE LLC", "BAILEY FAMILY LTD PARTNERSHIP"),
    ("care-of, no space", "TRANSPACIFIC RESOURCES %GTK COMMERCIAL", "TRANSPACIFIC RESOURCES"),
    ("care-of after a number", "PIONEERS OF ALASKA IGLOO 15 % MOA/CEMETERY", "PIONEERS OF ALASKA IGLOO 15"),
    ("share with loose space", "HANDELAND DONALD 50 % & BANNAN BREANNA 50%", "HANDELAND DONALD 50 % & BANNAN BREANNA 50%"),
    ("share, tight", "LEE JIM 50% & VANG NEDA 50%", "LEE JIM 50% & VANG NEDA 50%"),
    ("share, EA suffix", "MASON JUNG JA REVOCABLE TRUST 50% EA", "MASON JUNG JA REVOCABLE TRUST 50% EA"),
    ("c/o spelled out", "YOUNGER SVETLANA & ROBERT O III C/O PARAGON PROPERTIES INC", "YOUNGER SVETLANA & ROBERT O III"),
    ("backslash c\\o", "TKB LLC C\\O CANGE & CHAMBERS", "TKB LLC"),
    ("attn with colon", "MCKINLEY PROPERTIES INC  ATTN: 05-5080", "MCKINLEY PROPERTIES INC"),
    ("attn without colon", "FLT AURORA PARK LLC 43% ATTN LEAGLE DEPT", "FLT AURORA PARK LLC 43%"),
    ("skipped line 2", "HEITMAN FAMILY TRUST  HEITMAN MICHAEL", "HEITMAN FAMILY TRUST HEITMAN MICHAEL"),
    ("untouched", "SOISETH LYNN A & ANITA K", "SOISETH LYNN A & ANITA K"),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(FIXTURE, "scenario string, owner_name string, expected string")


def test_golden(df):
    wrong = df.withColumn("cleaned", clean_owner_name(F.col("owner_name"))).filter("cleaned != expected").collect()
    assert wrong == []


def test_contract_holds_on_fixture(df):
    res = {r.name: r.violations for r in ck.run_all({"t": df}, names.contract_checks(shares_lost=0, percent_kept=0)).collect()}
    assert res == {"cleaner_never_empties": 0, "no_agent_fragment_survives": 0, "cleaning_is_idempotent": 0,
                   "no_double_spaces": 0, "shares_lost_as_pinned": 0, "percent_kept_as_pinned": 0}


def test_assert_zero_raises(df):
    with pytest.raises(ck.ChecksFailed):
        ck.assert_zero({"t": df}, [ck.row("has_percent", "t", F.col("owner_name").contains("%"))])


def test_percent_usage_wildcard_trap(df):
    r = names.percent_usage(df).first()
    assert r.unescaped_like_matches == 12
    assert r.escaped_like_matches == r.names_with_percent == 7


def test_disposition_labels(spark):
    d = spark.createDataFrame([("PROPERTY OWNER OF RECORD",), ("ACME LLC",), ("X TRUST",), ("Y TTE",), ("Z",)], "owner_name string")
    got = {r.disposition: r.n for r in names.disposition(d).collect()}
    assert got == {"placeholder — unclassifiable": 1, "corporate token — rule suffices": 1,
                   "trust token — rule suffices": 1, "trust abbreviation — rule suffices": 1,
                   "residual — needs a model": 1}
