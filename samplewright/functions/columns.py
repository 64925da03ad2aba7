"""Column expressions that the operators share.

Missing values differ by operator, as in the feature jobs these serve; each
function states its rule. All are built-in expressions, so plans stay in
generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a file holds for a missing number or id.
MISSING = "-1"
EMPTY_LIBSVM = ("0", "0.0", "100000000", "100000000.0")
ILLEGAL_IDS = ("", "0")
MULTI_VALUE = "[,|;:]"


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def legal_string(c) -> Column:
    return col(c).isNotNull() & (F.trim(col(c).cast("string")) != "")


def legal_id(c) -> Column:
    """Not null, blank or '0'."""
    return F.coalesce(~F.trim(col(c).cast("string")).isin(*ILLEGAL_IDS), F.lit(False))


def all_digits(c) -> Column:
    return F.coalesce(col(c).rlike("^[0-9]+$"), F.lit(False))


def number_like(c) -> Column:
    """One digit, or several characters of digits and dots."""
    return F.coalesce(col(c).rlike("^([0-9]|[0-9.]{2,})$"), F.lit(False))


def number(c, kind: str = "double") -> Column:
    """Null where a value doesn't parse."""
    return col(c).try_cast(kind)


def zero_if_missing(c, kind: str | None = None) -> Column:
    """Null to 0, the column's type kept (or cast first)."""
    c = col(c).cast(kind) if kind else col(c)
    return F.coalesce(c, F.lit(0).cast(kind) if kind else F.lit(0))


def label_at_least(c, threshold) -> Column:
    """1 from the threshold on, else 0; null is 0."""
    return F.when(col(c) >= threshold, 1).otherwise(0)


def bin_index(x: Column, bounds: Column) -> Column:
    """0-based bin of right-closed intervals (b[i-1], b[i]]: how many bounds lie
    below x. NaN falls into the last bin. Null x or bounds: null."""
    return F.when(x.isNotNull() & bounds.isNotNull(), F.size(F.filter(bounds, lambda b: b < x)))


def zero_based(text: Column, bounds: Column) -> Column:
    """Bin of a string value; -1 where it isn't a plain number or there are no bounds."""
    value = F.when(number_like(text), number(text))
    return F.coalesce(F.when(F.size(bounds) > 0, bin_index(value, bounds)), F.lit(-1))


def one_based(x: Column, bounds: Column) -> Column:
    """Bin of a number, from 1; a null counts as 0."""
    return bin_index(zero_if_missing(x, "double"), bounds) + 1


def keyed_bin(text: Column, bounds: Column) -> Column:
    """Bin from 0; null for negative or unparseable values."""
    value = number(text)
    return F.when(value >= 0, bin_index(value, bounds))


def bin_or_raw(text: Column, bounds: Column) -> Column:
    """Bin as a string; what doesn't parse stays as it is."""
    return F.coalesce(bin_index(number(text), bounds).cast("string"), text)


def multi_values(c, pattern: str = MULTI_VALUE) -> Column:
    """Parts of a multi-valued string, in order, without empty ones."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), pattern), lambda v: F.trim(v) != "")


def cross(*parts: str) -> Column:
    """A feature cross; null where a part is null."""
    values = [col(p).cast("string") for p in sorted(set(parts))]
    return F.when(~F.exists(F.array(*values), lambda v: v.isNull()), F.concat_ws("_", *values))


def hash_share(*keys: str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the keys alone, so splits don't move
    when partitions do; from MD5, which other engines have too."""
    text = F.concat_ws("#", *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
