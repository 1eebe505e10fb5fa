"""String functions as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_RANGE = 1 << 32


def fold_hash(s: Column, seed: int, modulus: int) -> Column:
    """``h = h * seed + code`` over the characters of ``s``, reduced at each step so it cannot overflow.

    Characters above U+FFFF count as one code point.
    """
    chars = F.filter(F.split(s, ""), lambda c: c != "")
    return F.aggregate(
        chars,
        F.lit(0).cast("bigint"),
        lambda h, c: F.pmod(h * F.lit(seed) + F.ascii(c), F.lit(modulus).cast("bigint")),
    )


def java_hash(s: Column) -> Column:
    """The 32-bit signed string hash of the Java platform."""
    half = F.lit(INT_RANGE // 2)
    return F.pmod(fold_hash(s, 31, INT_RANGE) + half, F.lit(INT_RANGE)) - half


def bitmap_slot(s: Column, bits: int = 1 << 29, seed: int = 61) -> Column:
    """Slot of a value in a bitmap of ``bits`` bits."""
    return fold_hash(s, seed, bits)


def split_words(s: Column, sep_regex: str) -> Column:
    """Split, without the empty strings at the end."""
    return F.split(F.regexp_replace(s, f"(?:{sep_regex})+$", ""), sep_regex)


def not_blank(s: Column) -> Column:
    return F.length(F.trim(F.coalesce(s, F.lit("")))) > 0


def equals_ignore_case(s: Column, text: str) -> Column:
    return F.lower(s) == text.lower()
