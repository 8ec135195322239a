"""What tests share beside fixtures. Not in conftest: two folders have one, and only one module can bear that name."""

from __future__ import annotations

import datetime as dt


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
