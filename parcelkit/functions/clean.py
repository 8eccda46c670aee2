"""Cleaning and recoding rules as native Column expressions.

Every rule is an ordered ``when`` chain or arithmetic, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
LEAD = "Lead"
NON_LEAD = "Non-Lead"
UNKNOWN = "Unknown"
LEAD_GRR = "Lead/GRR"
STATUS_LEVELS = [LEAD, NON_LEAD, UNKNOWN]
# Model class -> imputed material category.
CLASS_TO_CATEGORY = {0: "Non-Lead", 1: "Non-Lead", 2: "Lead/GRR", 3: "Lead/GRR"}
# Yes-like tokens for 0/1 flags.
YES_TOKENS = ["yes", "y", "true", "t", "1"]
# Tokens read as missing at load (pandas' default NA strings that occur in practice).
NULL_TOKENS = ["", "NA", "N/A", "n/a", "null", "NULL", "None", "nan", "NaN"]
# Known-status filter values.
KNOWN_STATUS = [LEAD, NON_LEAD]
GRR_PHRASE = "galvanized requiring replacement"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed: the characters that a text strip removes (all Unicode blanks).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
              "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_lower(c) -> Column:
    """``str(v).strip().lower()``: strips leading/trailing whitespace of the
    set above (Spark ``trim`` removes spaces only); ``btrim`` avoids a regex."""
    return F.lower(F.btrim(_c(c).cast("string"), F.lit(WHITESPACE)))


def normalize_status(c) -> Column:
    """Null -> Unknown; 'non' and 'lead' -> Non-Lead; 'lead' -> Lead;
    yes/y -> Lead; no/n -> Non-Lead; else Unknown."""
    s = strip_lower(c)
    return (F.when(_c(c).isNull(), F.lit(UNKNOWN))
            .when(s.contains("non") & s.contains("lead"), F.lit(NON_LEAD))
            .when(s.contains("lead"), F.lit(LEAD))
            .when(s.isin("yes", "y"), F.lit(LEAD))
            .when(s.isin("no", "n"), F.lit(NON_LEAD))
            .otherwise(F.lit(UNKNOWN)))


def normalize_material(c) -> Column:
    """Exact 'lead' or GRR phrase -> Lead/GRR; 'unknown' -> Unknown;
    non-lead/copper/plastic/other or exact 'galvanized' -> Non-Lead; else Unknown."""
    s = strip_lower(c)
    return (F.when(_c(c).isNull(), F.lit(UNKNOWN))
            .when((s == "lead") | s.contains(GRR_PHRASE), F.lit(LEAD_GRR))
            .when(s.contains("unknown"), F.lit(UNKNOWN))
            .when(s.contains("non-lead") | s.contains("copper") | s.contains("plastic")
                  | s.contains("other") | (s == "galvanized"), F.lit(NON_LEAD))
            .otherwise(F.lit(UNKNOWN)))


def normalize_both(c) -> Column:
    """X3: 'non-lead' -> Non-Lead; 'lead' or GRR phrase -> Lead/GRR; else Unknown."""
    s = strip_lower(c)
    return (F.when(_c(c).isNull(), F.lit(UNKNOWN))
            .when(s.contains("non-lead"), F.lit(NON_LEAD))
            .when(s.contains("lead") | s.contains(GRR_PHRASE), F.lit(LEAD_GRR))
            .otherwise(F.lit(UNKNOWN)))


def class_to_category(cls) -> Column:
    k = to_double(cls)
    expr = F.lit(None).cast("string")
    chain = None
    for key, val in CLASS_TO_CATEGORY.items():
        chain = (F.when(k == float(key), F.lit(val)) if chain is None
                 else chain.when(k == float(key), F.lit(val)))
    return chain.otherwise(expr)


def impute_from_class(cat, cls) -> Column:
    """An Unknown category takes the model class' category (else stays Unknown)."""
    return F.when(_c(cat) == UNKNOWN,
                  F.coalesce(class_to_category(cls), F.lit(UNKNOWN))).otherwise(_c(cat))


def combine_sides(a, b) -> Column:
    """Any Lead/GRR -> Lead/GRR; else any Non-Lead -> Non-Lead; else Unknown."""
    a, b = _c(a), _c(b)
    return (F.when((a == LEAD_GRR) | (b == LEAD_GRR), F.lit(LEAD_GRR))
            .when((a == NON_LEAD) | (b == NON_LEAD), F.lit(NON_LEAD))
            .otherwise(F.lit(UNKNOWN)))


def to_double(c) -> Column:
    """Numeric coercion, bad text and NaN -> null. The cast alone would
    take a number with a type letter at its end ('1900d')."""
    s = F.lower(F.btrim(_c(c).cast("string")))
    d = s.try_cast("double")
    lettered = F.substring(s, -1, 1).isin("d", "f") & ~s.endswith("inf")
    return F.when(F.isnan(d) | lettered | s.contains("x"), F.lit(None).cast("double")).otherwise(d)


def epoch_ms_to_ts(c) -> Column:
    """Epoch milliseconds -> timestamp; bad -> null. Whole numbers of any
    type: a column with gaps is often read as double."""
    return F.timestamp_millis(F.coalesce(_c(c).cast("string").try_cast("bigint"), to_double(c).try_cast("bigint")))


def year_valid(y, cur_year: int, rule: str) -> Column:
    """F3 validity: rule 'a' 1800<=y<=cur; 'b'/'c' 0<y<=cur."""
    y = _c(y)
    if rule == "a":
        return y.between(1800, cur_year)
    return (y > 0) & (y <= cur_year)


def clean_year(y, cur_year: int) -> Column:
    """F3 (c): invalid years become null."""
    v = to_double(y)
    return F.when(year_valid(v, cur_year, "c"), v)


def yes_flag(c) -> Column:
    """Yes-like text -> 1, else (including null) 0."""
    return F.when(strip_lower(c).isin(*YES_TOKENS), F.lit(1)).otherwise(F.lit(0))


def zero_if_missing_int(c) -> Column:
    """X11: numeric coercion, missing -> 0, then integer."""
    return F.coalesce(to_double(c), F.lit(0.0)).cast("int")


def safe_ratio(num, den) -> Column:
    """X13 (form 1): num/den when den > 0 else 0."""
    return F.when(_c(den) > 0, _c(num) / _c(den)).otherwise(F.lit(0.0))


def ratio_or_zero(num, den) -> Column:
    """X13 (form 2): den = 0 -> missing -> 0 (nulls also -> 0)."""
    return F.coalesce(_c(num) / F.nullif(_c(den), F.lit(0.0)), F.lit(0.0))


def ratio_floor(num, den, floor: float = 1e-9) -> Column:
    """X13 (form 3): num / max(den, floor)."""
    return _c(num) / F.greatest(_c(den), F.lit(floor))


def finite_or_null(c) -> Column:
    """F5 helper: +-inf and NaN -> null."""
    x = _c(c)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


def round_half_even(c, n: int) -> Column:
    """NumPy/pandas ``round(n)``: scale, round half to even on the binary
    value (``rint``), unscale. (``bround`` rounds the exact decimal
    expansion instead and differs on values such as 0.15.)"""
    k = float(10 ** n)
    return F.rint(_c(c) * F.lit(k)) / F.lit(k)


def null_tokens_to_null(c) -> Column:
    """Apply the NA-token set after a CSV read (Spark's nullValue is one token)."""
    return F.when(_c(c).isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(_c(c))


# Fixed pattern for dataset ids in catalogue URLs (32 hex chars, '_', layer number).
DATASET_ID_PATTERN = r"([0-9a-f]{32}_[0-9]+)"


def sanitize_name(c) -> Column:
    """File-safe name: whitespace-stripped, runs outside [A-Za-z0-9_-]
    become '_', then leading/trailing '_' removed."""
    s = F.regexp_replace(F.regexp_replace(_c(c), r"^\s+|\s+$", ""), r"[^A-Za-z0-9_\-]+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")


def dataset_id(c) -> Column:
    """Dataset id extracted from a URL ('' -> null when absent)."""
    return F.nullif(F.regexp_extract(_c(c), DATASET_ID_PATTERN, 1), F.lit(""))
