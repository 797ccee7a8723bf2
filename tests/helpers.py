"""Small frame helpers for tests."""

from datetime import date, datetime


def ts(text):
    return datetime.fromisoformat(text) if text else None


def d(text):
    return date.fromisoformat(text) if text else None


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in picked.collect()], key=lambda r: tuple((x is not None, str(x)) for x in r))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
