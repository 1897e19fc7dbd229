"""Casts of text that give null instead of failing.

``try_cast`` raises and catches an exception for every text that does not fit,
which costs far more than the cast itself. A pattern sorts such text out first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHOLE = r"^\s*[-+]?\d+\s*$"
# the JVM would also take a trailing d or f
NUMBER = r"(?i)^\s*[-+]?((\d+\.?\d*|\.\d+)(e[-+]?\d+)?|nan|inf|infinity)\s*$"
GUARDS = {
    "int": WHOLE,
    "bigint": WHOLE,
    "float": NUMBER,
    "double": NUMBER,
    "timestamp": r"[-:]",
    "date": r"-",
}


def text_to(column: str, type_name: str) -> Column:
    """The text ``column`` as ``type_name``, null where it does not fit.

    A bare number is no time, although it could be read as a year.
    """
    cast = F.expr(f"try_cast(`{column}` AS {type_name})")
    guard = GUARDS.get(type_name)
    return cast if guard is None else F.when(F.col(f"`{column}`").rlike(guard), cast)
