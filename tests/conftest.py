import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from snapledger.session import get_session

    s = get_session("local[*]", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="snapledger-test-ckpt-"),
                          "spark.driver.memory": "6g"})
    yield s


def square(lon, lat, d=0.001):
    ring = [[lon, lat], [lon + d, lat], [lon + d, lat + d], [lon, lat + d], [lon, lat]]
    return json.dumps({"type": "Polygon", "coordinates": [ring]})


def feature_lines(parcels):
    """One NDJSON line per part: {id, owner, value, parts, lon, ...extra}."""
    lines = []
    for p in parcels:
        for i in range(1, p.get("parts", 1) + 1):
            rec = {"Parcel_ID": p["id"], "Parcel_ID_Count": i, "Owner_Name": p.get("owner"),
                   "Appraised_Total_Value": p.get("value"), "Appraisal_Year": 2026,
                   "PUBDATE": 1782864000000,  # 2026-07-01 UTC in epoch ms
                   "__geometry": square(p.get("lon", -149.9) + (i - 1) * 0.002, 61.2)}
            rec.update(p.get("extra", {}))
            if i > 1:
                rec.update(p.get("extra_later", {}))
            lines.append(json.dumps(rec))
    return "\n".join(lines) + "\n"


@pytest.fixture
def write_snapshot(tmp_path):
    def _w(name, parcels, raw_lines=()):
        d = tmp_path / "raw" / name
        d.mkdir(parents=True)
        (d / "page-00000.ndjson").write_text(feature_lines(parcels) + "".join(line + "\n" for line in raw_lines))
        return str(d)
    return _w
