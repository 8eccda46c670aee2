"""Column roles (P1-P13): which column of a layer plays which part.

A role is a row of ``ROLES``: names in order of preference, an optional test
of the column (numeric or text) and, where no listed name is present, tests
on the name or the type that any column may meet. ``columns`` evaluates one
row over ``df.schema`` (no data is read) and returns every match; ``column``
returns the first. Nothing is cut off: a caller that wants fewer columns
names them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField


@dataclass(frozen=True)
class Role:
    names: tuple = ()            # preferred names, in order
    numeric: bool = False        # only numeric columns qualify
    pattern: str = ""            # else: names that match, by search
    any_text: bool = False       # else: any text column
    any_case: bool = False       # listed names in any case, after their own
    either: bool = False         # listed names and pattern count alike, in column order
    required: bool = False       # no column is an error


# Fixed names and their order; they decide which column is read.
RACE_KEYS = {
    "total": ("totalE", "TOTAL", "Total", "POP"),
    "white": ("WhiteE", "WHITE", "White"),
    "black": ("BlackE", "BLACK", "Black"),
    "hispanic": ("HispanicE", "HISPANIC", "Hispanic"),
    "asian": ("AsianE", "ASIAN", "Asian"),
    "native": ("NativeE", "NATIVE", "Native"),
    "hipi": ("HIPIE", "NHPIE", "HIPI", "NHPI"),
}
WEIGHTS = ("Households", "HH", "HHTOTAL", "TotalHouseholds", "totalE", "TOTAL", "Total", "POP", "Population", "TOTPOP")
NAMES = ("Name", "NAME", "neighborhood", "Neighborhood", "neighborhood_name")
YEARS = ("yearstructbuilt", "YearBuilt", "year_built", "YEARBUILT")
ROLES: dict[str, Role] = {
    "name": Role(NAMES, any_text=True),                                          # P1
    "name_any_case": Role(NAMES, any_case=True),                                 # P1, map form
    "tract_id": Role(("GEOID", "GEOID10", "GEOID20", "geoid", "GEOCODE", "ID", "OBJECTID", "tract_id", "TRACT")),  # P2
    "race_pct": Role(("Pwhite", "Pblack", "Phispanic", "Pasian", "Pnative", "PHIPI"), numeric=True, pattern="^P"),  # P3
    **{f"race_{k}": Role(v) for k, v in RACE_KEYS.items()},                      # P4
    "income": Role(("MHI", "MEDHHINC"), numeric=True, pattern="(?i)income|median", either=True),  # P5
    "income_map": Role(("MHI", "MEDHHINC"), pattern="(?i)income|median", either=True),  # P5, map form
    "weight": Role(WEIGHTS, numeric=True, pattern="(?i)household|^(hh|total|pop|population|totpop)$"),  # P6
    "weight_listed": Role(WEIGHTS, numeric=True),                                # P6, first form
    "year": Role(YEARS),                                                         # P7
    "status": Role(("bothsidesstatus", "utilmaterial", "custmaterial", "everlead")),  # P8; none: constant Unknown
    "lead_percent": Role(pattern="(?i)(pct|percent).*lead|lead.*(pct|percent)"),  # P9
    "total_count": Role(("total_count", "n_total", "count", "total", "pipes_total")),  # P9
    "lead_count": Role(("total_lead", "n_lead", "lead_count", "pipes_lead")),    # P9
    "neighborhood": Role(("neighborhood_name", "neighborhood", "Neighborhood", "Name", "NAME"),
                         any_case=True, required=True),                          # P10
}


def columns(df: DataFrame, role: str | Role) -> list[str]:
    """All columns that play ``role``, best first."""
    r = ROLES[role] if isinstance(role, str) else role
    fields = {f.name: f for f in df.schema.fields if not r.numeric or isinstance(f.dataType, NumericType)}

    def search(test) -> list[str]:
        return [n for n, f in fields.items() if test(f)]

    def matches(f: StructField) -> bool:
        return bool(r.pattern) and re.search(r.pattern, f.name) is not None

    if r.either:
        found = search(lambda f: f.name in r.names or matches(f))
    else:
        lower = {n.lower() for n in r.names}
        found = ([n for n in r.names if n in fields]
                 or r.any_case and search(lambda f: f.name.lower() in lower)
                 or search(matches)
                 or r.any_text and search(lambda f: isinstance(f.dataType, StringType)) or [])
    if r.required and not found:
        raise ValueError(f"no column for {role}; columns: {', '.join(df.columns)}")
    return found


def column(df: DataFrame, role: str | Role) -> str | None:
    """The column that plays ``role``, or None."""
    return next(iter(columns(df, role)), None)


def race_counts(df: DataFrame) -> dict[str, str | None]:
    """The count column of each race key."""
    return {k: column(df, f"race_{k}") for k in RACE_KEYS}


def keep_present(df: DataFrame, keep) -> DataFrame:
    """The columns of ``keep`` that ``df`` has."""
    return df.select(*[F.col(f"`{c}`") for c in keep if c in df.columns])


def harmonise(df: DataFrame, mapping: dict[str, tuple[list[str], str]]) -> DataFrame:
    """For each canonical name, rename the first synonym present and cast
    it; absent columns become typed nulls."""
    cols = []
    for canon, (names, dtype) in mapping.items():
        src = column(df, Role(tuple(names)))
        expr = F.col(f"`{src}`").cast(dtype) if src else F.lit(None).cast(dtype)
        cols.append(expr.alias(canon))
    return df.select(*cols)
