"""Text and recoding expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_first_comma(text: str | Column) -> Column:
    """Remove the first comma only, then read as integer: NULL where another comma is left."""
    return F.regexp_replace(_col(text), "^([^,]*),", "$1").try_cast("int")


def strip_all(text: str | Column, part: str = "-") -> Column:
    """Remove every occurrence of ``part``, then read as number."""
    return F.replace(_col(text), F.lit(part), F.lit("")).try_cast("double")


def parse_duration(text: str | Column) -> Column:
    """Seconds of text such as ``1 min 2.5 sec`` or ``2.5 sec``."""
    t = _col(text)
    number = lambda unit: F.coalesce(
        F.regexp_extract(t, rf"([0-9]+(?:\.[0-9]+)?) *{unit}", 1).try_cast("double"), F.lit(0.0)
    )
    return F.when(t.rlike(r"[0-9] *(min|sec)"), number("min") * 60 + number("sec"))


def recode_label(value: str | Column, levels: Sequence[str] = ("fail", "pass")) -> Column:
    """Position of the value among ``levels`` from 0; NULL for an unknown level."""
    v = _col(value)
    coded = F.when(v == levels[0], 0)
    for code, level in enumerate(levels[1:], start=1):
        coded = coded.when(v == level, code)
    return coded


def recode_gender(value: str | Column, one: str = "female") -> Column:
    return (_col(value) == one).cast("int")


def filled(columns: Mapping[str, object]) -> dict[str, Column]:
    """Replace missing values by the given sentinel per column."""
    return {c: F.coalesce(F.col(c), F.lit(v)) for c, v in columns.items()}
