"""Column helpers shared by the operators; all stay inside the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import cache, reduce

from pyspark.sql import Column, functions as F

from brickfolio.contracts import COMMON_FACTORS, GENERIC_NAME_TOKENS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_nan(c) -> Column:
    """NaN and null mean the same thing in price data."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def finite(c) -> Column:
    """True for a present, finite number; never null."""
    c = col(c)
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def ratio(a, b) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(col(a), col(b))


def flag(c) -> Column:
    """Three-valued to two-valued: null counts as false."""
    return F.coalesce(col(c), F.lit(False))


def blank(c) -> Column:
    """Null or only spaces."""
    return F.coalesce(F.trim(col(c)) == "", F.lit(True))


def to_double(c) -> Column:
    return no_nan(F.expr(f"try_cast(`{c}` as double)") if isinstance(c, str) else c.try_cast("double"))


def to_long(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).try_cast("bigint")


def to_day(c, fmt: str = "yyyy-MM-dd") -> Column:
    """A strict day: other text gives null."""
    c = col(c)
    return F.when(F.length(c) == len(fmt), F.try_to_date(c, fmt) if hasattr(F, "try_to_date")
                  else F.to_date(F.try_to_timestamp(c, F.lit(fmt))))


def upper_trim(c) -> Column:
    return F.upper(F.trim(col(c)))


def tax_id(c) -> Column:
    """Fourteen digits, or null."""
    digits = F.regexp_replace(col(c), r"\D", "")
    return F.when(F.length(digits) == 14, digits)


def joined_flags(labels: Iterable[tuple[Column, str]], empty: str = "NONE") -> Column:
    """Names of the flags that are set, in the given order, joined with ``|``."""
    text = F.concat_ws("|", *[F.when(cond, F.lit(name)) for cond, name in labels])
    return F.when(text == "", F.lit(empty)).otherwise(text)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def nearest_factor(c) -> Column:
    """Struct(factor, relative_error) of the common factor closest to ``c``.

    Ties go to the first factor in the list, hence the position in the key.
    """
    c = col(c)
    options = F.array(*[
        F.struct(F.abs(c - F.lit(f)).alias("distance"), F.lit(i).alias("position"), F.lit(f).alias("factor"))
        for i, f in enumerate(COMMON_FACTORS)
    ])
    best = F.array_min(options)
    return F.struct(best["factor"].alias("factor"), (best["distance"] / best["factor"]).alias("relative_error"))


@cache
def _folding() -> tuple[str, str, dict[str, str]]:
    """Unicode compatibility folding to ASCII, derived from the Unicode tables.

    Code points that fold to one character go through ``translate``; the few
    that fold to several are replaced from a map.
    """
    single_from, single_to, several = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        folded = unicodedata.normalize("NFKD", char)
        if folded == char:
            continue
        kept = "".join(x for x in folded if x < "\x80")
        if len(kept) == 1:
            single_from.append(char)
            single_to.append(kept)
        elif kept:
            several[char] = kept
    return "".join(single_from), "".join(single_to), several


def ascii_fold(c) -> Column:
    source, target, several = _folding()
    c = col(c)
    pairs = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])
    expanded = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(pairs, ch), ch)), "")
    # a hash lookup per character; a regex class of this size is tested member by member
    has_several = F.translate(c, "".join(several), "") != c
    # most text is plain ASCII and skips both tables
    folded = F.translate(F.when(has_several, expanded).otherwise(c), source, target)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(folded, r"[^\x00-\x7F]", "")).otherwise(c)


def normal_text(c) -> Column:
    """Upper-case ASCII words with single spaces; null gives an empty string."""
    words = F.regexp_replace(F.upper(ascii_fold(c)), "[^A-Z0-9]+", " ")
    return F.coalesce(F.trim(words), F.lit(""))


def core_name(c) -> Column:
    """Name without the generic fund words."""
    generic = F.array(*[F.lit(t) for t in GENERIC_NAME_TOKENS])
    words = F.filter(F.split(normal_text(c), " "), lambda w: ~F.array_contains(generic, w))
    return F.array_join(words, " ")
