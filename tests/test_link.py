"""Address normaliser and the pair-free portfolio operator against a brute-force pairwise answer."""

from pyspark.sql import functions as F

from snapledger.functions.text import norm_address, zip5
from snapledger.operators import link


def test_norm_address_first_match_only(spark):
    df = spark.createDataFrame([("12 Street Street.",), (" 5 main  street apt 4b",), ("9 Circle Dr, Unit 7",),
                                (None,), ("1 ST STREET",)], "a string")
    got = [r[0] for r in df.select(norm_address(F.col("a"))).collect()]
    assert got == ["12 ST STREET", "5 MAIN ST", "9 CIR DR", "", "1 ST ST"]


def test_zip5(spark):
    df = spark.createDataFrame([("99587-1234",), ("AK 99501",), (None,)], "z string")
    assert [r[0] for r in df.select(zip5(F.col("z"))).collect()] == ["99587", "99501", ""]


def _parcels(spark):
    rows = []
    # owner A: three parcels at one mailing address, one home claims the exemption
    for i, (ptype, bldg, pre, site) in enumerate([("Residential", 1.0, None, "1 A STREET"),
                                                  ("Residential", 1.0, "OWNERS PRIMARY RESIDENCE", "10 HOME ROAD"),
                                                  ("Commercial", 0.0, None, "3 SHOP RD")]):
        rows.append((f"a{i}", "4" if i == 0 else "1", ptype, bldg, 100.0 * (i + 1), pre, site, "10 Home Road", "99587", "99587",
                     "OWNER A", "GIRDWOOD", "AK"))
    # owner B's Girdwood home whose mailing address is a muni home owned by someone else
    rows.append(("b0", "4", "Residential", 1.0, 50.0, None, "2 B ST", "7 Elm Street", "99501", "99501", "OWNER B", "ANCHORAGE", "AK"))
    rows.append(("c0", "1", "Residential", 1.0, 70.0, "OWNERS PRIMARY RESIDENCE", "7 ELM ST", "7 Elm St", "99501", "99501",
                 "OWNER C", "ANCHORAGE", "AK"))
    # redacted owner: unlinkable
    rows.append(("d0", "4", "Residential", 1.0, 10.0, None, "4 D ST", "4 D ST", "99587", "99587",
                 "PROPERTY OWNER OF RECORD", "GIRDWOOD", "AK"))
    schema = ("parcel_id string, tax_district string, property_type string, appraised_building_value double, "
              "appraised_total_value double, exemption_6_type string, parcel_address string, owner_address string, "
              "owner_zip string, gis_site_zipcode string, owner_name string, owner_city string, owner_state string")
    return spark.createDataFrame(rows, schema)


def _brute(lk, where):
    gw = lk.filter(where & F.col("is_home") & ~F.col("has_pre") & ~F.col("unlinkable")).alias("g")
    o = lk.alias("o")
    strict = gw.join(o, (F.col("o.oname") == F.col("g.oname")) & (F.col("o.mail_norm") == F.col("g.mail_norm"))
                     & (F.col("o.mail_zip5") == F.col("g.mail_zip5")) & ~F.col("o.unlinkable"))
    home = gw.join(o, (F.col("o.site_norm") == F.col("g.mail_norm")) & (F.col("o.site_zip5") == F.col("g.mail_zip5"))
                   & F.col("o.is_home"))
    cols = [F.col("g.parcel_id").alias("gw_parcel"), F.col("o.parcel_id").alias("pid"), F.col("o.is_home").alias("h"),
            F.col("o.has_pre").alias("p"), F.col("o.appraised_total_value").alias("v")]
    comb = strict.select(cols).unionByName(home.select(cols)).dropDuplicates(["gw_parcel", "pid"])
    return comb.groupBy("gw_parcel").agg(F.count_if("h").alias("n_homes"), F.count(F.lit(1)).alias("n_parcels"),
                                         F.sum("v").alias("total_value"), F.bool_or("p").alias("primary_found"))


def test_portfolio_matches_pairwise(spark):
    lk = link.linked(_parcels(spark))
    where = F.col("tax_district") == "4"
    got = sorted(map(tuple, link.portfolio(lk, where).collect()))
    want = sorted(map(tuple, _brute(lk, where).select("gw_parcel", "n_homes", "n_parcels", "total_value",
                                                       "primary_found").collect()))
    assert got == want
    assert dict((r[0], r[4]) for r in got) == {"a0": True, "b0": True}


def test_mail_trail_classes(spark):
    lk = link.linked(_parcels(spark))
    got = {r.mail_goes_to: r.n for r in link.mail_trail(lk, F.col("tax_district") == "4").collect()}
    assert got == {"An exempt muni home": 2, "A muni home without the exemption": 1}
