"""Column expressions that reproduce JDK string semantics the reference relies on.

All of them are Catalyst expressions (no Python in the row path), so they stay inside whole-stage
codegen or, for ``java_hash``, one JVM reflection call per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(s: ColumnOrName, regex: str) -> Column:
    """``String.split(regex)``: like Spark ``split`` but with trailing empty strings removed.

    JDK rules: ``"".split(x)`` is ``[""]``; a string made only of separators gives ``[]``; leading
    and inner empty strings are kept. The separator is a Java regular expression in both systems.
    """
    s = _col(s)
    pieces = F.split(s, regex, -1)
    # without the trailing empty pieces: up to the last piece that is not empty
    kept = F.aggregate(F.transform(pieces, lambda p, i: F.when(p != "", i + 1).otherwise(0)), F.lit(0), lambda a, x: F.greatest(a, x))
    exact = F.when(s == F.lit(""), F.array(F.lit(""))).otherwise(F.slice(pieces, F.lit(1), kept))
    if len(regex) == 1 and regex not in _REGEX_META:
        # a literal one-character separator: only a string ending with it can have trailing empties
        return F.when(s.endswith(regex), exact).otherwise(F.split(s, regex, -1))
    return exact


_REGEX_META = frozenset(".$|()[]{}^?*+\\")


def java_length(s: ColumnOrName) -> Column:
    """``String.length()``: UTF-16 code units (a character outside the BMP counts twice)."""
    return (F.octet_length(F.encode(_col(s), "UTF-16BE")) / 2).cast("int")


def java_hash(s: ColumnOrName) -> Column:
    """``String.hashCode()`` (signed 32-bit, ``31*h + unit`` over UTF-16 units).

    Spark's ``hash`` is Murmur3, so this calls the JDK through ``java_method``; a null input gives
    null (the JDK would throw).
    """
    s = _col(s)
    return F.when(s.isNotNull(), F.call_function("java_method", F.lit("java.util.Objects"), F.lit("hashCode"), s).cast("int"))


def java_double_text(d: ColumnOrName) -> Column:
    """``Double.toString``: Spark's double-to-string cast uses the JDK formatting (35.8, 1.0E10)."""
    return _col(d).cast("string")


def java_gt(a: ColumnOrName, b: ColumnOrName | float) -> Column:
    """The JDK's primitive ``a > b`` on doubles: false when either side is NaN (Spark's ``>`` orders
    NaN above every number)."""
    a = _col(a)
    b = F.lit(b) if isinstance(b, (int, float)) else _col(b)
    return ~F.isnan(a) & ~F.isnan(b) & (a > b)


def java_lt(a: ColumnOrName, b: ColumnOrName | float) -> Column:
    """The JDK's primitive ``a < b`` on doubles (false with NaN)."""
    return java_gt(b, a) if not isinstance(b, (int, float)) else java_gt(F.lit(b), a)
