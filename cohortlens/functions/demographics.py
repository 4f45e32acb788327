"""Demographic cleaning as Column expressions (no UDF, ANSI-safe).

birth_date     date from nullable year/month/day parts
age_in_years   completed years between two dates
standard_gender MALE / FEMALE / UNKNOWN
race_ethnicity one of eight labels by ordered first-match rules
zip5           the five-digit zip code or null
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def birth_date(year: ColumnOrName, month: ColumnOrName, day: ColumnOrName) -> Column:
    """Birth date from its parts; a missing part counts as 1.

    The parts are joined as ``y-m-d`` text and read as a date without a
    pattern.  A missing year gives ``1-m-d``, whose one-digit year is not a
    valid date text, and impossible dates (Feb 30, month 13) are not either:
    all of them give NULL, with ANSI mode on or off.
    """
    parts = [F.coalesce(_c(p), F.lit(1)).cast("string") for p in (year, month, day)]
    return F.try_to_date(F.concat_ws("-", *parts))


def age_in_years(at: ColumnOrName, born: ColumnOrName) -> Column:
    """Completed years from ``born`` to ``at`` (bigint); negative before birth.

    Whole months count from day-of-month to day-of-month, and from a month's
    last day to another month's last day, so Feb 29 to Feb 28 of a common
    year is a full year.
    """
    return F.floor(F.months_between(_c(at), _c(born), roundOff=False) / 12)


def standard_gender(gender: ColumnOrName) -> Column:
    g = F.upper(_c(gender))
    return F.when(g == "MALE", "MALE").when(g == "FEMALE", "FEMALE").otherwise("UNKNOWN")


HISPANIC = "Hispanic or Latino Any Race"
BLACK = "Black or African American Non-Hispanic"
WHITE = "White Non-Hispanic"
ASIAN = "Asian Non-Hispanic"
PACIFIC = "Native Hawaiian or Other Pacific Islander Non-Hispanic"
OTHER = "Other Non-Hispanic"

# race/ethnicity rules in order; the first match wins.
# (input, test, text, label): input "ethnicity" or "race"; test "equals" is
# exact equality, "contains" a case-sensitive substring test.  A null input
# matches no rule.  No match gives RACE_ETHNICITY_DEFAULT.
RACE_ETHNICITY_RULES = [
    ("ethnicity", "equals", "Hispanic or Latino", HISPANIC),
    ("race", "contains", "Hispanic", HISPANIC),
    ("race", "contains", "Black", BLACK),
    ("race", "equals", "African American", BLACK),
    ("race", "contains", "White", WHITE),
    ("race", "equals", "Asian or Pacific Islander", "Unknown"),
    ("race", "contains", "Asian", ASIAN),
    ("race", "contains", "Filipino", ASIAN),
    ("race", "contains", "Chinese", ASIAN),
    ("race", "contains", "Korean", ASIAN),
    ("race", "contains", "Vietnamese", ASIAN),
    ("race", "contains", "Japanese", ASIAN),
    ("race", "contains", "Bangladeshi", ASIAN),
    ("race", "contains", "Pakistani", ASIAN),
    ("race", "contains", "Nepalese", ASIAN),
    ("race", "contains", "Laotian", ASIAN),
    ("race", "contains", "Taiwanese", ASIAN),
    ("race", "contains", "Thai", ASIAN),
    ("race", "contains", "Sri Lankan", ASIAN),
    ("race", "contains", "Burmese", ASIAN),
    ("race", "contains", "Okinawan", ASIAN),
    ("race", "contains", "Cambodian", ASIAN),
    ("race", "contains", "Bhutanese", ASIAN),
    ("race", "contains", "Singaporean", ASIAN),
    ("race", "contains", "Hmong", ASIAN),
    ("race", "contains", "Malaysian", ASIAN),
    ("race", "contains", "Indonesian", ASIAN),
    ("race", "contains", "Pacific", PACIFIC),
    ("race", "contains", "Polynesian", PACIFIC),
    ("race", "contains", "Native Hawaiian", PACIFIC),
    ("race", "contains", "Micronesian", PACIFIC),
    ("race", "contains", "Melanesian", PACIFIC),
    ("race", "contains", "Other", OTHER),
    ("race", "contains", "Multiple", OTHER),
    ("race", "contains", "More", OTHER),
]
RACE_ETHNICITY_DEFAULT = "UNKNOWN"


def race_ethnicity(
    race: ColumnOrName,
    ethnicity: ColumnOrName,
    rules: list[tuple[str, str, str, str]] = RACE_ETHNICITY_RULES,
    default: str = RACE_ETHNICITY_DEFAULT,
) -> Column:
    """Fold the ordered rules into one CASE expression."""
    inputs = {"race": _c(race), "ethnicity": _c(ethnicity)}
    tests = {"equals": lambda c, t: c == t, "contains": lambda c, t: c.contains(t)}

    def test(rule):
        source, kind, text, _ = rule
        return tests[kind](inputs[source], F.lit(text))

    first, *rest = rules
    chain = reduce(lambda acc, r: acc.when(test(r), r[3]), rest, F.when(test(first), first[3]))
    return chain.otherwise(default)


def zip5(zip_code: ColumnOrName) -> Column:
    """The first five characters after trimming blanks, if all are digits; else null."""
    z = F.trim(_c(zip_code))
    five = F.when(F.length(z) >= 5, z.substr(1, 5))
    return F.when(five.rlike("[0-9]{5}"), five)
