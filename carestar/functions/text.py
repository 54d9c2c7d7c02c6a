"""Text cleaning and text-to-type conversion, as SQL expressions.

Each function takes and returns SQL text, so that a table with dozens of columns
is projected in one ``selectExpr``; wrap the text in ``F.expr`` for a Column.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Plain decimal notation only: no exponent, no thousands separator.
_DECIMAL_TEXT = "^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *$"
_WHOLE_TEXT = "^ *[+-]?[0-9]+ *$"
_CONTROLS = "concat(char(13), char(10), char(9))"


def clipped(value: str, width: int) -> str:
    """Trim spaces (only spaces) and keep the first ``width`` characters."""
    return f"substring(trim({value}), 1, {width})"


def blank_to_null(value: str) -> str:
    return f"if(trim({value}) <> '', {value}, NULL)"


def flattened(value: str, style: str = "control") -> str:
    """Trim, then turn carriage return, line feed and tab into spaces.

    ``style="literal"`` replaces the two-character texts backslash-r, -n and -t
    instead, for parity with a system that reads the escapes literally.
    """
    value = f"trim({value})"
    if style == "control":
        return f"translate({value}, {_CONTROLS}, '   ')"
    if style == "literal":
        for letter in "rnt":
            value = f"replace({value}, concat(char(92), '{letter}'), ' ')"
        return value
    raise ValueError(f"unknown style {style!r}")


def to_number(value: str, target: T.DataType) -> str:
    """NULL for blanks and for anything that is not plain decimal notation."""
    pattern = _WHOLE_TEXT if isinstance(target, T.IntegerType) else _DECIMAL_TEXT
    cast = f"try_cast({value} AS {target.simpleString()})"
    return f"if({value} RLIKE '{pattern}', {cast}, NULL)"


def to_when(value: str, target: T.DataType, blank: str = "null") -> str:
    """Date or moment; unreadable text gives NULL.

    A blank gives NULL (an open end), or 1900-01-01 with ``blank="epoch1900"``.
    """
    kind = target.simpleString()
    parsed = f"try_cast({value} AS {kind})"
    if blank == "null":
        return parsed
    if blank == "epoch1900":
        return f"if(trim({value}) = '', CAST('1900-01-01' AS {kind}), {parsed})"
    raise ValueError(f"unknown blank rule {blank!r}")
