"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskbeacon.config import ANCHOR_DATE, CRIME_GROUPS


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- B1 -------
def clean_region_token(c) -> Column:
    """Region token cleaner (order matters).

    NULL -> UNKNOWN; trim; strip one trailing ``.0``; exact "" or "NAN" ->
    UNKNOWN; upper-case. Lower-case "nan" therefore survives as "NAN".
    """
    t = F.regexp_replace(F.trim(F.coalesce(col_or(c).cast("string"), F.lit("UNKNOWN"))), r"\.0$", "")
    return F.upper(F.when(t.isin("", "NAN"), F.lit("UNKNOWN")).otherwise(t))


# ---------------------------------------------------------------- B2 -------
# --- fixed values: city primary types per crime group ----------------------
CITY_TYPE_GROUPS = [
    ("THEFT", "theft_larceny"),
    ("ASSAULT", "assault_battery"),
    ("BATTERY", "assault_battery"),
    ("INTIMIDATION", "assault_battery"),
    ("BURGLARY", "burglary"),
    ("ROBBERY", "robbery"),
    ("MOTOR VEHICLE THEFT", "motor_vehicle_theft"),
    ("NARCOTICS", "drug_narcotics"),
    ("OTHER NARCOTIC VIOLATION", "drug_narcotics"),
]


def map_city_type(c) -> Column:
    """City primary type -> crime group (trim + upper), else NULL.

    A NULL input reads as the text "NONE"/"NAN" in the original and maps to
    NULL as well.
    """
    v = F.upper(F.trim(col_or(c).cast("string")))
    out = F.lit(None).cast("string")
    for raw, grp in reversed(CITY_TYPE_GROUPS):
        out = F.when(v == raw, F.lit(grp)).otherwise(out)
    return out


# ---------------------------------------------------------------- B3 -------
# --- fixed values: national offense rules, in evaluation order -------------
# Each rule is (group, tests); a rule fires when any of its tests holds.
# Tests: "cat_has" = category contains, "cat_eq" = category equals,
# "code" = offense code equals, "name_has" = offense name contains.
OFFENSE_RULES = [
    ("theft_larceny", [("cat_has", "LARCENY/THEFT")]),
    ("assault_battery", [("cat_has", "ASSAULT OFFENSES")]),
    ("burglary", [("cat_has", "BURGLARY/BREAKING & ENTERING"), ("code", "220")]),
    ("robbery", [("cat_eq", "ROBBERY"), ("code", "120")]),
    ("motor_vehicle_theft", [("cat_has", "MOTOR VEHICLE THEFT"), ("code", "240")]),
    ("drug_narcotics", [("cat_has", "DRUG/NARCOTIC OFFENSES")]),
    ("assault_battery", [("name_has", "ASSAULT")]),
    ("theft_larceny", [("name_has", "LARCENY"), ("name_has", "THEFT")]),
    ("burglary", [("name_has", "BURGLARY")]),
    ("robbery", [("name_has", "ROBBERY")]),
    ("motor_vehicle_theft", [("name_has", "MOTOR VEHICLE THEFT")]),
    ("drug_narcotics", [("name_has", "DRUG"), ("name_has", "NARCOTIC")]),
]


def _text_upper(c) -> Column:
    # A missing value is rendered as the text "NAN" by the original cleaner.
    return F.upper(F.coalesce(col_or(c).cast("string"), F.lit("NAN")))


def map_offense(name, category, code) -> Column:
    """National offense (name, category, code) -> crime group; first rule wins."""
    fields = {"cat_has": _text_upper(category), "cat_eq": _text_upper(category),
              "code": _text_upper(code), "name_has": _text_upper(name)}

    def test(kind: str, needle: str) -> Column:
        value = fields[kind]
        return value == needle if kind in ("cat_eq", "code") else value.contains(needle)

    out = F.lit(None).cast("string")
    for grp, tests in reversed(OFFENSE_RULES):
        cond = test(*tests[0])
        for t in tests[1:]:
            cond = cond | test(*t)
        out = F.when(cond, F.lit(grp)).otherwise(out)
    return out


# ---------------------------------------------------------------- C1/C2 ----
def time_bin(date_col, window_days: int, anchor: str = ANCHOR_DATE) -> Column:
    """Start date of the time window holding ``date_col``.

    7 days: the Monday of the ISO week. 3 days: floor-divided blocks anchored
    at ``anchor`` (also correct before the anchor).
    """
    d = F.to_date(col_or(date_col))
    w = int(window_days)
    if w == 7:
        return F.to_date(F.date_trunc("week", d))
    if w == 3:
        a = F.lit(anchor).cast("date")
        k = F.floor(F.datediff(d, a) / F.lit(3)).cast("int")
        return F.date_add(a, k * F.lit(3))
    raise ValueError(f"Unsupported time window {window_days}; expected 3 or 7")


# ---------------------------------------------------------------- C9 -------
def region_state(c) -> Column:
    """State part of a region id: text before ``__``, upper; empty/NAN -> UNK."""
    s = F.split(F.upper(F.trim(F.coalesce(col_or(c).cast("string"), F.lit("UNK")))), "__", 2).getItem(0)
    return F.when(s.isin("", "NAN"), F.lit("UNK")).otherwise(s)


# ---------------------------------------------------------------- C14 ------
def calendar_columns(time_col) -> dict[str, Column]:
    t = col_or(time_col)
    wk = F.weekofyear(t)
    ang = F.lit(2.0 * math.pi) * wk.cast("double") / F.lit(52.0)
    return {
        "month": F.month(t).cast("double"),
        "weekofyear": wk.cast("double"),
        "quarter": F.quarter(t).cast("double"),
        "sin_weekofyear": F.sin(ang),
        "cos_weekofyear": F.cos(ang),
    }


def group_count_col(group: str) -> str:
    return f"count_grp_{group}"


GROUP_COUNT_COLS = [group_count_col(g) for g in CRIME_GROUPS]


def side_by_side(*one_row_frames):
    """Place single-row aggregates next to each other (equi-join on a
    constant key, each side broadcast - every input has exactly one row)."""
    from pyspark.sql import functions as _F
    out = one_row_frames[0].withColumn("__one", _F.lit(1))
    for f in one_row_frames[1:]:
        out = out.join(_F.broadcast(f.withColumn("__one", _F.lit(1))), "__one", "inner")
    return out.drop("__one")
