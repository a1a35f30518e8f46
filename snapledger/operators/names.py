"""Owner-name cleaning and the counts that justify it (all one-scan aggregations)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.text import (AGENT_FRAGMENT_PATTERN, CORPORATE_NAME_PATTERN, OWNER_NAME_PLACEHOLDER,
                                       TRUST_ABBREVIATION_DISPOSITION_PATTERN, TRUST_ABBREVIATION_PATTERN,
                                       TRUST_NAME_TOKEN, clean_owner_name, re2)
from snapledger.operators import checks as ck

# --- fixed values ----------------------------------------------------------------
OWNER_LINE_LENGTH = 30
# ---------------------------------------------------------------------------------

SHARE = re2(r"[0-9]%")
SHARE_LOOSE = re2(r"[0-9]\s*%")


def clean(df: DataFrame, col: str = "owner_name", out: str = "cleaned") -> DataFrame:
    return df.withColumn(out, clean_owner_name(F.col(col)))


def percent_usage(df: DataFrame, col: str = "owner_name") -> DataFrame:
    n = F.col(col)
    return df.agg(
        F.count_if(n.contains("%")).alias("names_with_percent"),
        F.count_if(n.rlike(SHARE_LOOSE)).alias("fractional_share"),
        F.count_if(n.rlike(re2(r"\s%\s*[A-Z]"))).alias("care_of_percent"),
        F.count_if(n.rlike(re2(r"\sC/O\s|\sC\\O\s"))).alias("care_of_spelled_out"),
        F.count_if(n.rlike(re2(r"\sATTN:?\s"))).alias("attn"),
        # an unescaped LIKE '%' matches every non-NULL row: the wildcard trap
        F.count_if(n.like("%")).alias("unescaped_like_matches"),
        F.count_if(n.like("%\\%%")).alias("escaped_like_matches"),
    )


def signal_counts(df: DataFrame, col: str = "owner_name", line1: str = "owner_line_1") -> DataFrame:
    n = F.col(col)
    return df.agg(
        F.count(F.lit(1)).alias("ambiguous_parcels"),
        F.count_if(n.contains(TRUST_NAME_TOKEN)).alias("trust_named"),
        F.count_if(n.rlike(re2(CORPORATE_NAME_PATTERN))).alias("corporate_named"),
        F.count_if(F.length(line1) == OWNER_LINE_LENGTH).alias("line_1_at_char_cap"),
        F.count_if(n == OWNER_NAME_PLACEHOLDER).alias("placeholder"),
    )


def why_left(categorized: DataFrame) -> DataFrame:
    """Abstained rows by basis with their share (percent of the abstained)."""
    a = categorized.filter(F.col("owner_type").isNull())
    g = a.groupBy("basis").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))        # over the few aggregated rows
    return g.select("basis", "n", F.round(100.0 * F.col("n") / total, 1).alias("pct_of_ambiguous"))


def truncation(df: DataFrame) -> DataFrame:
    cap = OWNER_LINE_LENGTH
    return df.agg(
        F.count_if(F.length("owner_line_1") == cap).alias("line_1_at_cap"),
        F.count_if(F.length("owner_line_2") == cap).alias("line_2_at_cap"),
        F.count_if(F.length("owner_line_3") == cap).alias("line_3_at_cap"),
        F.count_if((F.length("owner_line_1") == cap) & F.col("owner_line_2").isNull()
                   & F.col("owner_line_3").isNull()).alias("truncated_unrecoverably"))


def truncation_examples(df: DataFrame, col: str = "owner_name", k: int = 12) -> DataFrame:
    """The first ``k`` names, by name, that end at the cap and go on nowhere (repeated names count as often as they come)."""
    cut = (F.length("owner_line_1") == OWNER_LINE_LENGTH) & F.col("owner_line_2").isNull() & F.col("owner_line_3").isNull()
    return df.filter(cut).select(col).orderBy(col).limit(k)


def structure_checks() -> list[ck.Check]:
    joined = F.trim(F.concat(F.col("owner_line_1"), F.lit(" "), F.coalesce(F.col("owner_line_2"), F.lit("")),
                             F.lit(" "), F.coalesce(F.col("owner_line_3"), F.lit(""))))
    too_long = None
    for c in ("owner_line_1", "owner_line_2", "owner_line_3", "owner_line_4"):
        p = F.length(c) > OWNER_LINE_LENGTH
        too_long = p if too_long is None else too_long | p
    dbl = lambda c: F.coalesce(F.col(c), F.lit("")).contains("  ")
    return [
        ck.row("owner_name_is_joined_lines", "t", ~F.col("owner_name").eqNullSafe(joined)),
        ck.row("owner_lines_within_cap", "t", too_long),
        ck.row("owner_line_4_present", "t", F.col("owner_line_4").isNull()),
        ck.row("double_space_explained", "t", F.col("owner_name").contains("  ")
               & (F.coalesce(F.col("owner_line_2"), F.lit("")) != "")
               & ~(dbl("owner_line_1") | dbl("owner_line_2") | dbl("owner_line_3"))),
    ]


def contract_checks(col: str = "owner_name", shares_lost: int = 3, percent_kept: int = 9) -> list[ck.Check]:
    """Cleaner contract: never empties, no fragment left, idempotent, no double spaces, pinned exceptions."""
    n = F.col(col)
    c = clean_owner_name(n)
    lost = F.count_if(n.rlike(SHARE) & ~c.rlike(SHARE))
    kept = F.count_if(c.contains("%") & ~c.rlike(SHARE_LOOSE))
    return [
        ck.row("cleaner_never_empties", "t", c == ""),
        ck.row("no_agent_fragment_survives", "t", c.rlike(re2(AGENT_FRAGMENT_PATTERN))),
        ck.row("cleaning_is_idempotent", "t", clean_owner_name(c) != c),
        ck.row("no_double_spaces", "t", c.contains("  ")),
        ck.agg("shares_lost_as_pinned", "t", F.abs(F.lit(shares_lost) - lost)),
        ck.agg("percent_kept_as_pinned", "t", F.abs(F.lit(percent_kept) - kept)),
    ]


def not_names(df: DataFrame, col: str = "owner_name") -> DataFrame:
    """(trap, parcels, example) for placeholder / backslash / trust abbreviations (one scan + unpivot)."""
    n = F.col(col)
    wide = df.agg(
        F.count_if(n == OWNER_NAME_PLACEHOLDER).alias("a"),
        F.count_if(n.contains("\\")).alias("b"),
        F.count_if(n.rlike(re2(TRUST_ABBREVIATION_PATTERN)) & ~n.contains(TRUST_NAME_TOKEN)).alias("c"))
    return wide.selectExpr(
        "stack(3, 'placeholder, no owner on file', a, "
        "'backslash for hyphen or slash', b, "
        "'trust abbreviated, TRUST token absent', c) AS (trap, parcels)")


def traps(abstained: DataFrame, col: str = "owner_name") -> DataFrame:
    """(trap, ambiguous_parcels, example): ``not_names`` over the rows without a label, with the first name of each trap."""
    n = F.col(col)
    found = {"placeholder, no owner on file": n == OWNER_NAME_PLACEHOLDER, "backslash for hyphen or slash": n.contains("\\"),
             "trust abbreviated, TRUST token absent": n.rlike(re2(TRUST_ABBREVIATION_PATTERN)) & ~n.contains(TRUST_NAME_TOKEN)}
    wide = abstained.agg(*[F.struct(F.lit(trap).alias("trap"), F.count_if(hit).alias("ambiguous_parcels"), F.min(F.when(hit, n)).alias("example")).alias(f"t{i}")
                           for i, (trap, hit) in enumerate(found.items())])
    return wide.select(F.explode(F.array(*wide.columns)).alias("t")).select("t.*")


def disposition_of(name: Column) -> Column:
    # the five labels are fixed values
    return (F.when(name == OWNER_NAME_PLACEHOLDER, "placeholder — unclassifiable")
            .when(name.rlike(re2(CORPORATE_NAME_PATTERN)), "corporate token — rule suffices")
            .when(name.contains(TRUST_NAME_TOKEN), "trust token — rule suffices")
            .when(name.rlike(re2(TRUST_ABBREVIATION_DISPOSITION_PATTERN)), "trust abbreviation — rule suffices")
            .otherwise("residual — needs a model"))


def disposition(ambiguous: DataFrame, col: str = "owner_name") -> DataFrame:
    d = ambiguous.select(disposition_of(clean_owner_name(F.col(col))).alias("disposition"))
    g = d.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))        # over at most five rows
    return g.select("disposition", "n", F.round(100.0 * F.col("n") / total, 1).alias("pct"))


def casualties(df: DataFrame, col: str = "owner_name") -> DataFrame:
    """Distinct names where cleaning lost a share or left an unparseable %."""
    n = F.col(col)
    c = clean_owner_name(n)
    a = df.filter(n.rlike(SHARE) & ~c.rlike(SHARE)).select(
        F.lit("share destroyed").alias("problem"), n.alias("owner_name"), c.alias("cleaned")).distinct()
    b = df.filter(c.contains("%") & ~c.rlike(SHARE_LOOSE)).select(
        F.lit("% left unparsed").alias("problem"), n.alias("owner_name"), c.alias("cleaned")).distinct()
    return a.unionByName(b)


def diff(df: DataFrame, col: str = "owner_name", k: int = 20) -> DataFrame:
    """Before/after for names the cleaner changes (first k by name)."""
    n = F.col(col)
    c = clean_owner_name(n)
    return df.filter(n != c).select(n.alias("owner_name"), c.alias("cleaned")).orderBy("owner_name", "cleaned").limit(k)
