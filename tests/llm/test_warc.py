"""Archives written and read back; the reader on hand-made archives."""

import base64
import gzip
import hashlib

from snapledger.llm import warc

PAGES = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, None), (4, "u\r\nx", ""), (5, "u5", "é\r\n\r\nWARC/1.1\r\n\r\n"),
         (9, "u9", "<p>same</p>"), (7, "u7", "big" * 200_000), (None, "nobody", "<p>same</p>")]
SCHEMA = "page_id long, url string, html string, record_type string"


def pages(spark):
    return spark.createDataFrame([(*p, "clash") for p in PAGES], SCHEMA).repartition(3)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    got = {r["page_id"]: tuple(r)[1:] for r in warc.round_trip(pages(spark)).collect()}
    for i, _, h in PAGES:
        same = max((j for j, _, x in PAGES if j is not None and (x or "") == (h or "")), default=None)
        revisit = i is not None and i != same
        assert got[i] == (len((h or "").encode()), sha(h), "revisit" if revisit else "response", same if revisit else None)
    small = {r["page_id"]: r["record_type"] for r in warc.round_trip(pages(spark), min_bytes=12).collect()}
    assert set(small.values()) == {"response"}
    assert warc.round_trip(pages(spark).where("false")).count() == 0


def test_payloads_come_back_whole(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark), path)
    rows = warc.read(spark, path).where("record_type = 'response'").collect()
    assert {bytes(r["payload"]).decode() for r in rows} == {h or "" for _, _, h in PAGES}
    for r in rows:
        assert r["payload_digest"] == "sha1:" + sha(bytes(r["payload"]).decode())
    revisits = warc.read(spark, path).where("record_type = 'revisit'").collect()
    ids = {r["headers"]["x-page-id"]: r["record_id"] for r in rows}
    assert {r["headers"]["warc-refers-to"] for r in revisits} == {ids["9"], ids["4"]}
    assert all(bytes(r["payload"]) == b"" for r in revisits)


def test_digests_are_those_of_what_was_read(spark, tmp_path):
    """A block that was damaged after writing shows: digest and length come from the bytes read, not from headers."""
    path = tmp_path / "w"
    warc.write(pages(spark), str(path), compression="none")
    for f in path.glob("part-*"):
        f.write_bytes(f.read_bytes().replace(b"bigbig", b"pigbig", 1))
    (path / "._SUCCESS.crc").unlink(missing_ok=True)
    for f in path.glob(".part-*.crc"):
        f.unlink()
    rows = {r["headers"].get("x-page-id"): r for r in warc.read(spark, str(path), payload="digest").where("record_type = 'response'").collect()}
    assert all(r["payload"] is None for r in rows.values())
    assert rows["7"]["read_digest"] == sha("pig" + "big" * 199_999) and rows["7"]["payload_digest"] == "sha1:" + sha("big" * 200_000)
    assert rows["9"]["read_digest"] == sha("<p>same</p>") and rows["9"]["read_bytes"] == 11
    ids = [r["record_id"] for r in warc.read(spark, str(path), payload=False).collect()]
    assert len(set(ids)) == len(PAGES)


def test_pushdown(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark), path)
    df = warc.read(spark, path, payload=False).where("record_type = 'revisit' and target_uri like 'http://a%'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.replace("PushedFilters", "") or "record_type" not in plan.split("BatchScan")[0]
    rows = df.collect()
    assert sorted(r["target_uri"] for r in rows) == ["http://a/1", "http://a/2"] and {r["payload"] for r in rows} == {None}
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("content_length",), 3)]))
    assert len(left) == 1 and len(reader.tests) == 1


def record(kind, body, **headers):
    lines = [f"WARC-Type: {kind}", f"Content-Length: {len(body)}", *[f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nhello"
    one = record("warcinfo", b"software: x\r\n") + record("response", body, Content_Type="application/http;msgtype=response")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(one[: one.index(b"WARC/1.0", 5)]) + gzip.compress(one[one.index(b"WARC/1.0", 5):]))
    (tmp_path / "b.warc").write_bytes(record("resource", b"raw\r\n\r\n" * 50_000, WARC_Target_URI="x:y") + record("metadata", b""))
    (tmp_path / "_SUCCESS").write_bytes(b"x")
    rows = {r["record_type"]: r for r in warc.read(spark, str(tmp_path)).collect()}
    assert bytes(rows["response"]["payload"]) == b"hello" and rows["response"]["content_length"] == len(body)
    assert bytes(rows["resource"]["payload"]) == b"raw\r\n\r\n" * 50_000 and bytes(rows["metadata"]["payload"]) == b""
    assert len(rows) == 4


def test_reads_cut_anywhere():
    """The same records however the store hands out the bytes, with blocks read or passed over."""
    class Drip:
        def __init__(self, data, step):
            self.data, self.step, self.at = data, step, 0

        def read(self, n):
            got = self.data[self.at:self.at + min(n, self.step)]
            self.at += len(got)
            return got

    data = b"".join(record("resource", b"x\r\n\r\n" * k, WARC_Target_URI=f"x:{k}") for k in range(9))
    for step in range(1, 40):
        got = []
        for k, (headers, length, take) in enumerate(warc.records(Drip(data, step))):
            got.append((headers["warc-target-uri"], length, take() if k % 2 else None))
        assert got == [(f"x:{k}", 5 * k, b"x\r\n\r\n" * k if k % 2 else None) for k in range(9)]
