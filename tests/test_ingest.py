"""Whole runs: what the gates refuse never reaches the table, and every run leaves a ledger row."""

import json

import pytest

from snapledger.operators.gates import GateError
from snapledger.sources import ingest, publish, store
from snapledger.sources.fields import FieldSpec

SOURCE = ingest.Source([FieldSpec("A", "a"), FieldSpec("N", "n", "int")], "K", "k", 2026)


@pytest.fixture
def run(spark, tmp_path):
    root, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")

    def go(ts, rows, server_count=None, raw=(), **limits):
        d = tmp_path / "raw" / ts[:10]
        d.mkdir(parents=True, exist_ok=True)
        (d / "page.ndjson").write_text("".join(json.dumps({"K": k, "A": a, "N": n}) + "\n" for k, a, n in rows) + "".join(x + "\n" for x in raw))
        n = len(rows) + len(raw) if server_count is None else server_count
        return ingest.ingest(spark, root, ledger, str(d), SOURCE, ts, server_count=n, limits=ingest.Limits(**limits))

    go.table = lambda: publish.checkout(spark, root)[0]
    go.ledger = lambda: store.read_ledger(spark, ledger).orderBy("started_at").collect()
    return go


def test_runs_and_ledger(run):
    base = [(str(i), "x", i) for i in range(20)]
    assert run("2024-01-01 00:00:00", base) == (0, True)
    assert run("2024-02-01 00:00:00", [*base[1:], ("0", "y", 0), ("new", "z", 1)]) == (1, True)
    assert run("2024-02-01 00:00:00", [*base[1:], ("0", "y", 0), ("new", "z", 1)]) == (1, False)       # a replay
    assert run("2024-03-01 00:00:00", [*base[1:], ("0", "y", 0), ("new", "z", 1)]) == (2, False)       # nothing changed
    rows = run.ledger()
    assert [(r.status, r.new_parcels, r.changed_parcels, r.retired_parcels, r.unchanged_parcels) for r in rows] == [
        ("success", 20, 0, 0, 0), ("success", 1, 1, 0, 19), ("success", 0, 0, 0, 21)]
    assert all(r.archive_bytes > 0 and r.server_count == r.source_features for r in rows)


@pytest.mark.parametrize("fault", [
    {"rows": 20, "server_count": 40},                            # a transfer that broke off
    {"rows": 10},                                                # half of the keys gone
    {"rows": 20, "raw": ['{"K": "9']},                           # a broken line
    {"rows": 20, "raw": ['{"K": "b", "N": "much"}']},            # a value that can't be read
])
def test_refused_runs_leave_the_table(run, fault):
    base = [(str(i), "x", i) for i in range(20)]
    run("2024-01-01 00:00:00", base)
    with pytest.raises(GateError):
        run("2024-02-01 00:00:00", base[: fault["rows"]], fault.get("server_count"), fault.get("raw", ()))
    assert run.table().count() == 20 and run.table().where("is_current").count() == 20
    assert [r.status for r in run.ledger()] == ["success", "refused"]
    run("2024-03-01 00:00:00", base[:10], allow_shrink=True)
    assert run.table().where("is_current").count() == 10


def test_a_key_that_comes_back(run):
    """Gone in one run and back in the next: a new version after a gap, not the old one reopened."""
    base = [(str(i), "x", i) for i in range(40)]
    run("2024-01-01 00:00:00", base)
    run("2024-02-01 00:00:00", base[1:])
    run("2024-03-01 00:00:00", base)
    got = sorted((str(r.valid_from)[:10], str(r.valid_to)[:10]) for r in run.table().where("k = '0'").collect())
    assert got == [("2024-01-01", "2024-02-01"), ("2024-03-01", "None")]
