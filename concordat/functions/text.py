"""Text functions: Column expressions, and their driver-side twins for headers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What profiling takes for numbers and booleans.
INT_PATTERN = r"^[+-]?[0-9]+\z"
FLOAT_PATTERN = r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?\z"
BOOLEANS = ("true", "false", "True", "False", "TRUE", "FALSE")


def normalised(c: Column) -> Column:
    """Lower case, letters and digits of ASCII only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def spaced(c: Column) -> Column:
    """Lower case, other runs than ASCII letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def canonical(c: Column) -> Column:
    """Lower case, letters and digits of any script."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def is_int(c: Column) -> Column:
    return c.rlike(INT_PATTERN)


def is_float(c: Column) -> Column:
    return c.rlike(FLOAT_PATTERN)


def is_bool(c: Column) -> Column:
    return c.isin(*BOOLEANS)


DATE_FIELDS = {"%Y": r"(?<Y>[0-9]{4})", "%m": r"(?<m>1[0-2]|0?[1-9])", "%d": r"(?<d>3[01]|[12][0-9]|0?[1-9])"}


def is_date(c: Column, formats: tuple[str, ...]) -> Column:
    """Whether a value reads as a calendar date in one of the formats (of %Y, %m, %d); fields may lack leading zeros."""
    found = F.lit(False)
    for f in formats:
        parts = re.findall(r"%[A-Za-z]|[^%]+", f)
        order = [p for p in parts if p.startswith("%")]
        if unknown := set(order) - set(DATE_FIELDS):
            raise ValueError(f"date fields {sorted(unknown)} are not known")
        pattern = "^" + "".join(re.sub(r"\?<\w>", "", DATE_FIELDS[p]) if p in DATE_FIELDS else re.escape(p) for p in parts) + r"\z"
        pick = {p: F.regexp_extract(c, pattern, i + 1) for i, p in enumerate(order)}
        ok = c.rlike(pattern)
        if "%d" in pick:
            whole = F.concat_ws("-", pick.get("%Y", F.lit("2000")), F.lpad(pick.get("%m", F.lit("1")), 2, "0"), F.lpad(pick["%d"], 2, "0"))
            ok = ok & F.try_to_timestamp(whole, F.lit("yyyy-MM-dd")).isNotNull()
        found = found | ok
    return found


def to_number(c: Column) -> Column:
    """A double, or null where the text is not a plain number; Java's suffixes (5d, 5f) are not taken."""
    return F.when(F.trim(c).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|(?i)^[+-]?(nan|inf|infinity)$"), c.try_cast("double"))


def trigrams(c: Column) -> Column:
    """Distinct character trigrams; a shorter text is one of its own, an empty one has none."""
    n = F.length(c)
    many = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))
    return F.when(n == 0, F.array().cast("array<string>")).when(n < 3, F.array(c)).otherwise(many)


def jaccard(a: Column, b: Column) -> Column:
    """Share of the union that both arrays have; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def normalised_text(s: str) -> str:
    return re.sub("[^a-z0-9]+", "", s.lower())


def jaro(a: str, b: str) -> float:
    """Jaro similarity with whole transpositions."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    mine = []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == c), None)
        if j is not None:
            free[j] = False
            mine.append(c)
    if not mine:
        return 0.0
    theirs = [c for c, f in zip(b, free, strict=True) if not f]
    swaps = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    m = len(mine)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str, weight: float = 0.1, longest: int = 4) -> float:
    """Jaro similarity raised by the common prefix, at any level of similarity."""
    base, k = jaro(a, b), 0
    while k < min(longest, len(a), len(b)) and a[k] == b[k]:
        k += 1
    return base + k * weight * (1 - base)
