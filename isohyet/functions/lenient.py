"""Column functions: trimming, missing values and casts that give NULL instead of an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the file format: what stands for a missing value.
NA_STRINGS = ("NA", "")

INTEGER = r"^[+-]?\d+$"
FLOAT = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
DATE_FIRST = r"^\d{4}-\d{2}-\d{2}"


#: What counts as white space (Unicode); trim() alone takes blanks only.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def na_to_null(c: Column, na_strings: Sequence[str] = NA_STRINGS) -> Column:
    t = trimmed(c)
    return F.when(~t.isin(*na_strings), t)


def present(c: Column, na_strings: Sequence[str] = NA_STRINGS) -> Column:
    """True where a raw field has a value."""
    return ~F.coalesce(trimmed(c), F.lit("")).isin(*na_strings)


def to_int(c: Column) -> Column:
    """`5.0`, text and overflow give NULL."""
    return F.when(c.rlike(INTEGER), c.try_cast("int"))


def to_double(c: Column) -> Column:
    return F.when(c.rlike(FLOAT), c.try_cast("double"))


def to_timestamp(c: Column) -> Column:
    """Date, `date time` and ISO forms; a bare year gives NULL."""
    return F.when(c.rlike(DATE_FIRST), c.try_cast("timestamp_ntz"))


CASTS = {"timestamp_ntz": to_timestamp, "int": to_int, "double": to_double, "string": lambda c: c}


def typed(c: Column, kind: str, na_strings: Sequence[str] = NA_STRINGS) -> Column:
    """A raw field as a value of its type."""
    return CASTS[kind](na_to_null(c, na_strings))


def size_text(n_files: Column, n_bytes: Column) -> Column:
    """`{n} files, ~{size}` in decimal units, one decimal."""
    unit = lambda div, name: F.format_string(f"%.1f {name}", n_bytes / div)
    size = F.when(n_bytes > 1_000_000_000, unit(1e9, "GB")).when(n_bytes > 1_000_000, unit(1e6, "MB")).when(n_bytes > 1_000, unit(1e3, "KB")).otherwise(F.format_string("%d B", n_bytes))
    return F.concat(F.format_string("%d files, ~", n_files), size)


def whole_days(first: Column, last: Column) -> Column:
    """Days of 24 hours from first to last, rounded down."""
    micros = F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def in_year(ts: Column, year: int) -> Column:
    """year(ts) = year as a range, which Parquet scans can use."""
    return (ts >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (ts < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))
