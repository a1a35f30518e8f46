"""Column-returning helpers: every one builds a JVM-side expression (no Python UDF)."""

from snapledger.functions.text import (  # noqa: F401
    AGENT_FRAGMENT_PATTERN,
    CORPORATE_NAME_PATTERN,
    OWNER_NAME_PLACEHOLDER,
    STREET_ABBREVIATIONS,
    TRUST_NAME_TOKEN,
    clean_owner_name,
    first_match_replace,
    institutional_base,
    norm_address,
    re2,
    zip5,
)
from snapledger.functions.values import (  # noqa: F401
    capped,
    cents,
    duck_int,
    fmt_dollars,
    guarded,
    normalise,
    plausible_year,
    ts_ntz,
)
