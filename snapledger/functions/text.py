"""Text cleaning and normalisation as Column expressions.

Spark's ``regexp_replace`` is always global and uses Java regex, where ``$``
also matches before a final newline and ``\\s`` includes the vertical tab.  The
patterns below are written in the RE2 dialect they were specified in; ``re2()``
rewrites the two constructs whose meaning differs so results stay identical.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the specification for identical results) ------
# Mail-routing fragment: from here to the end names an agent, not the owner.
AGENT_FRAGMENT_PATTERN = r"\s(%\s*[A-Z]|C/O\s|C\\O\s|ATTN:?\s).*$"
# Stand-in the source uses when it has no owner name on file.
OWNER_NAME_PLACEHOLDER = "PROPERTY OWNER OF RECORD"
# Owner-name guards used by the classification rule.
TRUST_NAME_TOKEN = "TRUST"
CORPORATE_NAME_PATTERN = r"(^| )(LLC|INC|CORP|LP|LTD)(\.|,|$| )"
# Trust abbreviations (the TRUST token absent).
TRUST_ABBREVIATION_PATTERN = r"(^| )(TR|TRS|TTE|TTES|TRUSTEE|TRUSTEES)(\.|,|/|$| )"
TRUST_ABBREVIATION_DISPOSITION_PATTERN = r"(^| )(TR|TRS|TTE|TTES|TRUSTEE)(\.|,|/|$| )"
# Long street words and the abbreviation site addresses use, in this order.
STREET_ABBREVIATIONS = [
    ("STREET", "ST"), ("AVENUE", "AVE"), ("ROAD", "RD"),
    ("DRIVE", "DR"), ("LANE", "LN"), ("CIRCLE", "CIR"),
    ("COURT", "CT"), ("PLACE", "PL"), ("BOULEVARD", "BLVD"),
    ("HIGHWAY", "HWY"), ("PARKWAY", "PKWY"), ("TRAIL", "TRL"),
]
# Trailing unit designator dropped from addresses.
UNIT_SUFFIX_PATTERN = r" (APT|UNIT|STE|SUITE|#) ?[A-Z0-9-]+$"
# -----------------------------------------------------------------------------

_WS = r"[ \t\n\f\r]"


def re2(pattern: str) -> str:
    """Rewrite an RE2 pattern for Java regex: ``\\s`` -> explicit class, bare ``$`` -> ``\\z``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            out.append(_WS if nxt == "s" else pattern[i:i + 2])
            i += 2
            continue
        out.append(r"\z" if ch == "$" else ch)
        i += 1
    return "".join(out)


def first_match_replace(col: Column, pattern: str, replacement: str) -> Column:
    """Replace only the leftmost match (RE2 ``regexp_replace`` without the 'g' flag)."""
    java_repl = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col, "(?s)^(.*?)(?:" + re2(pattern) + ")", "$1" + java_repl)


def clean_owner_name(col: Column) -> Column:
    """Cut the agent fragment (care-of %, C/O, C\\O, ATTN), squeeze spaces, trim."""
    no_agent = F.regexp_replace(col, re2(AGENT_FRAGMENT_PATTERN), "")
    return F.trim(F.regexp_replace(no_agent, re2(r"\s{2,}"), " "))


def _replace_first_word(s: Column, word: Column, repl: Column) -> Column:
    """Replace the leftmost ' WORD ' or a trailing ' WORD' by ``repl`` -- without a regex.

    Same result as a first-match replace of `` WORD$| WORD `` (both alternatives
    start with the blank, so the leftmost match is the smaller start position).
    """
    inner = F.instr(s, F.concat(F.lit(" "), word, F.lit(" ")))
    n = F.length(word) + 1
    at_end = F.when(s.endswith(F.concat(F.lit(" "), word)), F.length(s) - n + 1).otherwise(F.lit(0))
    pos = F.when((inner > 0) & ((at_end == 0) | (inner < at_end)), inner).otherwise(at_end)
    width = F.when((inner > 0) & (pos == inner), n + 1).otherwise(n)
    head = F.substr(s, F.lit(1), pos - 1)
    tail = F.substr(s, pos + width, F.length(s) + 1)
    return F.when(pos > 0, F.concat(head, repl, tail)).otherwise(s)


def norm_address(col: Column) -> Column:
    """Upper/trim, strip ``.,``, squeeze blanks, drop a trailing unit, abbreviate street words.

    Each street word is replaced at its *first* occurrence only, in list order.
    The twelve replacements are one ``aggregate`` over the word pairs: the
    accumulator is a lambda variable, so the expression stays linear in size
    (an unrolled chain would reference each step several times).
    """
    e = F.regexp_replace(F.upper(F.trim(F.coalesce(col, F.lit("")))), "[.,]", "")
    e = F.regexp_replace(e, re2(r"\s+"), " ")
    e = F.regexp_replace(e, re2(UNIT_SUFFIX_PATTERN), "")
    pairs = F.array(*[F.struct(F.lit(long).alias("w"), F.lit(f" {short} ").alias("r"))
                      for long, short in STREET_ABBREVIATIONS])
    e = F.aggregate(pairs, e, lambda acc, p: _replace_first_word(acc, p["w"], p["r"]))
    return F.trim(e)


def zip5(col: Column) -> Column:
    return F.substring(F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", ""), 1, 5)


def institutional_base(col: Column) -> Column:
    """Strip a trailing ' - LAND' and fold the NAVITE misspelling into NATIVE."""
    return F.replace(F.regexp_replace(col, re2(" - LAND$"), ""), F.lit("NAVITE"), F.lit("NATIVE"))


def is_corporate_name(col: Column) -> Column:
    return F.coalesce(col, F.lit("")).rlike(re2(CORPORATE_NAME_PATTERN))


def is_trust_named(col: Column) -> Column:
    return F.coalesce(col, F.lit("")).contains(TRUST_NAME_TOKEN)


def sql_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def like_escape(text: str) -> str:
    return re.sub(r"([%_\\])", r"\\\1", text)
