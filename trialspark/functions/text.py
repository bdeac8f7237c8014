"""Text and geography expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_maturity(x: Column, marker: str = "RM") -> Column:
    """The number after a marker word; null when there is none."""
    return F.nullif(F.regexp_extract(x, rf"{marker}\s*([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double")


def without_prefix(x: Column, pattern: str) -> Column:
    return F.trim(F.regexp_replace(x, f"^{pattern}", ""))


def without_decimal_tail(x: Column) -> Column:
    """Drop a trailing ``.0`` left by a number read as text."""
    return F.regexp_replace(x, r"\.0+$", "")


def replaced(x: Column, pattern: str, by: str) -> Column:
    """Replace a pattern; a text that becomes empty reads null."""
    return F.nullif(F.trim(F.regexp_replace(x, pattern, by)), F.lit(""))


def group_part(x: Column, position: int, separator: str = "-") -> Column:
    """The whole number at a 1-based position of a separated id; null when absent."""
    parts = F.split(x, separator)
    return F.when(F.size(parts) > 2, F.get(parts, F.lit(position - 1)).try_cast("int"))


def group_stage(x: Column) -> Column:
    return group_part(x, 2)


def group_maturity(x: Column) -> Column:
    """Maturity of a group id, on the day scale."""
    rm = group_part(x, 3)
    return F.when(rm <= 10, rm * 5 + 80).otherwise(rm)


def place_id(latitude: Column, longitude: Column, scale: int = 100, width: int = 5) -> Column:
    """Hemisphere letters and zero-padded hundredths of degrees."""

    def side(x: Column, negative: str, positive: str) -> Column:
        digits = F.lpad(F.round(F.abs(x) * scale).cast("bigint").cast("string"), width, "0")
        return F.concat(F.when(x < 0, F.lit(negative)).otherwise(F.lit(positive)), digits)

    return F.concat(side(latitude, "S", "N"), side(longitude, "W", "E"))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    """Great-circle distance in the unit of ``radius``."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    h = h + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(h))


def tokens(x: Column, separators: str = r"[,;/ ]+") -> Column:
    """Upper-case tokens of a text, empty ones removed, each once."""
    return F.array_distinct(F.filter(F.split(F.upper(F.trim(x)), separators), lambda s: s != ""))


def has_all_and_none(x: Column, expected: Sequence[str], forbidden: Sequence[str]) -> Column:
    """True when a token list holds every expected code and none of the forbidden ones."""
    ok = F.lit(True)
    for code in expected:
        ok = ok & F.array_contains(x, code)
    for code in forbidden:
        ok = ok & ~F.array_contains(x, code)
    return ok
