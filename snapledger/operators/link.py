"""Record linkage: normalised addresses, mail trail, owner portfolios.

Skew: shared mailing addresses (property managers) can hold a large share of
all rows.  Portfolios are therefore computed from *group aggregates* joined
back on the group key -- |A u B| = |A| + |B| - |A n B| per home -- and never by
emitting pairs inside a group.  Each aggregate has one row per group, so the
joins are key->key and a hot group costs one row, not n^2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.text import OWNER_NAME_PLACEHOLDER, norm_address, zip5
from snapledger.operators import stats
from snapledger.session import cut_lineage

# --- fixed values ----------------------------------------------------------------
MUNI_CITIES = ("ANCHORAGE", "EAGLE RIVER", "CHUGIAK", "GIRDWOOD", "JBER", "INDIAN",
               "BIRD CREEK", "FORT RICHARDSON", "ELMENDORF AFB", "PETERS CREEK", "EKLUTNA")
PRIMARY_RESIDENCE = "OWNERS PRIMARY RESIDENCE"
# ---------------------------------------------------------------------------------


def _u(c: str) -> Column:
    return F.upper(F.trim(F.coalesce(F.col(c), F.lit(""))))


def linked(df: DataFrame) -> DataFrame:
    """Normalised identity columns plus is_home / has_pre / unlinkable flags."""
    d = df.select(
        "parcel_id", "tax_district", "appraised_total_value",
        ((F.col("property_type") == "Residential") & (F.col("appraised_building_value") > 0)).alias("is_home"),
        F.coalesce(F.col("exemption_6_type") == PRIMARY_RESIDENCE, F.lit(False)).alias("has_pre"),
        norm_address(F.col("parcel_address")).alias("site_norm"),
        norm_address(F.col("owner_address")).alias("mail_norm"),
        zip5(F.col("owner_zip")).alias("mail_zip5"),
        zip5(F.col("gis_site_zipcode")).alias("site_zip5"),
        _u("owner_name").alias("oname"), _u("owner_city").alias("ocity"), _u("owner_state").alias("ostate"))
    return d.withColumn("unlinkable", (F.col("oname") == OWNER_NAME_PLACEHOLDER) | (F.col("oname") == "")
                        | (F.col("mail_norm") == ""))


def _focus(lk: DataFrame, where: Column, linkable_only: bool) -> DataFrame:
    f = lk.filter(where & F.col("is_home") & ~F.col("has_pre"))
    return f.filter(~F.col("unlinkable")) if linkable_only else f


def mail_trail(lk: DataFrame, where: Column) -> DataFrame:
    """Where does each focus home's tax bill go?  (class, n, share)."""
    gw = _focus(lk, where, False)
    sites = (lk.filter((F.col("site_norm") != "") & F.col("is_home"))
             .groupBy(F.col("site_norm").alias("s_norm"), F.col("site_zip5").alias("s_zip5"))
             .agg(F.bool_or("has_pre").alias("site_has_pre")))
    # what is no street address matches no site: such rows (a hot key) get keys of their own
    street = F.col("mail_norm").rlike("^[0-9]")
    g = gw.select("mail_norm", "mail_zip5", "ostate", "ocity", street.alias("street"),
                  F.when(street, F.col("mail_norm")).otherwise(F.concat(F.lit("#"), F.xxhash64("parcel_id"))).alias("key"))
    j = g.join(sites, (F.col("key") == F.col("s_norm")) & (F.col("mail_zip5") == F.col("s_zip5")), "left")
    cls = (F.when(~F.col("street") & (F.col("mail_zip5") == "99587"), "PO box in Girdwood")
           .when(~F.col("street"), "PO box / other non-street")
           .when(F.col("site_has_pre"), "An exempt muni home")
           .when(F.col("s_norm").isNotNull(), "A muni home without the exemption")
           .when(F.col("ostate") != "AK", "A street address outside Alaska")
           .when(~F.col("ocity").isin(*MUNI_CITIES), "A street address in AK, outside the muni")
           .otherwise("In the muni, but no home matched"))
    g = j.groupBy(cls.alias("mail_goes_to")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("mail_goes_to", "n", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("share"))


def _group_stats(d: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    v = F.col("appraised_total_value")
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(prefix + "parcels"),
        F.count_if(F.col("is_home")).alias(prefix + "homes"),
        F.sum(v).alias(prefix + "value"),
        F.count(v).alias(prefix + "valued"),
        F.bool_or("has_pre").alias(prefix + "pre"))


def portfolio(lk: DataFrame, where: Column) -> DataFrame:
    """Per focus home: its owner's muni portfolio = strict link U mail-home link (distinct parcels).

    strict   : parcels with the same owner name, mailing address and zip (not unlinkable)
    mail_home: homes whose site address is the owner's mailing address
    Columns: gw_parcel, n_homes, n_parcels, total_value, primary_found.

    |A u B| = |A| + |B| - |A n B|: A and A n B share A's key, so ONE aggregation
    over the owner groups carries both (the intersection as conditional
    aggregates); B is one aggregation over site addresses.  Two key->key joins.
    """
    keys = ["oname", "mail_norm", "mail_zip5"]
    gw = _focus(lk, where, True).select(F.col("parcel_id").alias("gw_parcel"), *keys)
    v = F.col("appraised_total_value")
    # in both links: a home standing at its own mailing address
    both = F.col("is_home") & (F.col("site_norm") == F.col("mail_norm")) & (F.col("site_zip5") == F.col("mail_zip5"))
    a = lk.filter(~F.col("unlinkable")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("a_parcels"), F.count_if(F.col("is_home")).alias("a_homes"),
        F.sum(v).alias("a_value"), F.count(v).alias("a_valued"), F.bool_or("has_pre").alias("a_pre"),
        F.count_if(both).alias("ab_parcels"), F.sum(F.when(both, v)).alias("ab_value"),
        F.count(F.when(both, v)).alias("ab_valued"))
    homes = lk.filter(F.col("is_home")).select(
        F.col("site_norm").alias("mail_norm"), F.col("site_zip5").alias("mail_zip5"),
        "appraised_total_value", "is_home", "has_pre")
    b = _group_stats(homes, ["mail_norm", "mail_zip5"], "b_")
    j = gw.join(a, keys, "left").join(b, ["mail_norm", "mail_zip5"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    valued = z("a_valued") + z("b_valued") - z("ab_valued")
    total = F.coalesce(F.col("a_value"), F.lit(0.0)) + F.coalesce(F.col("b_value"), F.lit(0.0)) \
        - F.coalesce(F.col("ab_value"), F.lit(0.0))
    return j.select(
        "gw_parcel",
        (z("a_homes") + z("b_homes") - z("ab_parcels")).alias("n_homes"),
        (z("a_parcels") + z("b_parcels") - z("ab_parcels")).alias("n_parcels"),
        F.when(valued > 0, total).alias("total_value"),
        (F.coalesce(F.col("a_pre"), F.lit(False)) | F.coalesce(F.col("b_pre"), F.lit(False))).alias("primary_found"))


def outcome_of(n_homes: Column, primary_found: Column) -> Column:
    return (F.when(~primary_found, "No exempt primary found in muni")
            .when(n_homes == 2, "2nd home (primary + Girdwood)")
            .when(n_homes == 3, "3rd home")
            .otherwise("4th home or beyond"))


def outcomes(portfolios: DataFrame) -> DataFrame:
    """Outcome label per focus home: (outcome, n, median_portfolio)."""
    # derived once: the counts and the medians both read it
    d = cut_lineage(portfolios.select(outcome_of(F.col("n_homes"), F.col("primary_found")).alias("outcome"), "total_value"), "outcomes")
    return stats.with_medians(d.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")), d, "outcome",
                              {"median_portfolio": "total_value"})


def cards(trail: DataFrame, portfolios: DataFrame) -> DataFrame:
    """(card, value): share of tax bills that go to an exempt home, portfolios with a primary home, those of three homes
    or more, and the median value of the former."""
    found = cut_lineage(portfolios.where("primary_found").select("n_homes", "total_value", F.lit(1).alias("all")), "verified")
    one = trail.agg(F.coalesce(F.sum(F.when(F.col("mail_goes_to") == "An exempt muni home", F.col("n"))) / F.sum("n"), F.lit(0.0)).alias("exempt_share"))
    counts = found.agg(F.count(F.lit(1)).cast("double").alias("verified_2nd_plus"), F.count_if(F.col("n_homes") >= 3).cast("double").alias("third_plus"))
    median = stats.exact_median(found, "all", "total_value", "median_portfolio").agg(F.max("median_portfolio").alias("median_portfolio"))
    wide = one.crossJoin(counts).crossJoin(median)                          # one row each
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("card"), F.col(c).alias("value")) for c in wide.columns])).alias("c")).select("c.*")


def top_portfolios(lk: DataFrame, where: Column, k: int = 20) -> DataFrame:
    """Owners of focus homes ranked by total muni value over their strict-link parcels.

    Group stats per (name, mailing address, zip) are computed once and summed per
    (name, city, state), so no parcel pairs are formed.
    """
    from snapledger.functions.values import fmt_dollars

    keys = ["oname", "mail_norm", "mail_zip5"]
    focus = _focus(lk, where, True).select(*keys, "ocity", "ostate").distinct()
    a = _group_stats(lk.filter(~F.col("unlinkable")), keys, "a_")
    g = focus.join(a, keys).groupBy("oname", "ocity", "ostate").agg(
        F.sum("a_homes").alias("homes"), F.sum("a_parcels").alias("parcels"),
        F.sum("a_value").alias("total_value"), F.bool_or("a_pre").alias("primary_claimed"))
    top = g.orderBy(F.desc_nulls_last("total_value"), "oname", "ocity", "ostate").limit(k)
    return top.select(
        F.col("oname").alias("owner"), F.concat_ws(", ", "ocity", "ostate").alias("mail_city"),
        "homes", "parcels", fmt_dollars(F.col("total_value")).alias("muni_total_value"),
        F.when(F.col("primary_claimed"), "yes").otherwise("").alias("primary_claimed"))


def owner_home(df: DataFrame, area: Column, is_home: Column, has_pre: Column) -> DataFrame:
    """Non-exempt homes by where the owner lives (zip / state), with share per area."""
    bucket = (F.when(F.col("owner_zip").like("99587%"), "Girdwood")
              .when(F.upper(F.trim(F.col("owner_state"))) == "AK", "Elsewhere in Alaska")
              .when(F.col("owner_state").isNull() | (F.trim(F.col("owner_state")) == ""), "Unknown")
              .otherwise("Outside Alaska"))
    d = df.filter(is_home & ~F.coalesce(has_pre, F.lit(False))).select(area.alias("area"), bucket.alias("owner_home"))
    g = d.groupBy("area", "owner_home").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("area")))


def top_cities(df: DataFrame, where: Column, k: int = 15) -> DataFrame:
    city = F.coalesce(F.upper(F.trim(F.col("owner_city"))), F.lit("UNKNOWN"))
    state = F.coalesce(F.upper(F.trim(F.col("owner_state"))), F.lit("?"))
    return (df.filter(where).groupBy(city.alias("owner_city"), state.alias("owner_state"))
            .agg(F.count(F.lit(1)).alias("homes")).orderBy(F.desc("homes"), "owner_city", "owner_state").limit(k))
