"""Scalar column functions (F1, F3, F7 of the inventory).

All built-in expressions: they stay inside whole-stage codegen and Catalyst
can fold and push them, unlike a registered Python/Scala UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a JVM ``String.trim`` removes: every code point <= U+0020.
_JVM_BLANKS = "".join(chr(c) for c in range(0x21))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c: str | Column) -> Column:
    """Trim like the JVM's ``String.trim`` (all control chars and blanks)."""
    return F.btrim(_col(c), F.lit(_JVM_BLANKS))


def epoch_seconds(ts_ntz: str | Column) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ, floored for positive times,
    independent of the session time zone (NTZ is read as UTC wall clock)."""
    return F.timestamp_diff(
        "SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(ts_ntz))


def epoch_to_ntz(secs: str | Column, tz: str = "UTC") -> Column:
    """Epoch seconds -> wall-clock TIMESTAMP_NTZ in zone ``tz``.

    Built from NTZ arithmetic so the session time zone never leaks in.
    """
    base = F.timestamp_add("SECOND", _col(secs), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if tz.upper() in ("UTC", "Z", "+00:00"):
        return base
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), base)


def yearmonth(secs: str | Column, tz: str = "UTC") -> Column:
    """epoch seconds -> ``yyyyMM`` as int (the reference's date UDF)."""
    ntz = epoch_to_ntz(secs, tz)
    return (F.year(ntz) * 100 + F.month(ntz)).cast("int")


def log10_int(c: str | Column) -> Column:
    """base-10 log by change of base, ln(m)/ln(10), as in the reference."""
    return F.log(_col(c).cast("double")) / F.log(F.lit(10.0))
