"""Checks of columns, parameters and windows, made before a plan is built."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

#: Column names that may hold free text.
TEXT_NAMES = frozenset({"narrative", "consumer complaint narrative", "complaint_text"})
TEXT_SUFFIXES = ("_narrative", "_text")


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def forbid_text_columns(df: DataFrame, table: str) -> DataFrame:
    """Refuses tables with columns that are named as free text."""
    bad = [c for c in df.columns if c.lower() in TEXT_NAMES or c.lower().endswith(TEXT_SUFFIXES)]
    if bad:
        raise ValueError(f"{table} holds prohibited text columns: {', '.join(bad)}")
    return df


def require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


def require_none(df: DataFrame, message: str) -> None:
    """Raises, with their number, if df has rows."""
    n = df.count()
    if n:
        raise ValueError(f"{message}: {n} rows")


def day(value) -> dt.date:
    """A date from a date, a timestamp or ISO text; the time of day is dropped."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)[:10])


def split_windows(config: Mapping[str, object], names: tuple[str, ...] = ("train", "validation", "test")) -> dict[str, tuple[dt.date, dt.date]]:
    """Ordered, disjoint windows from <name>_start and <name>_end."""
    out: dict[str, tuple[dt.date, dt.date]] = {}
    last = None
    for name in names:
        start, end = day(config[f"{name}_start"]), day(config[f"{name}_end"])
        require(start <= end, f"{name} ends before it starts")
        require(last is None or start > last, f"{name} overlaps the window before it")
        out[name], last = (start, end), end
    return out
