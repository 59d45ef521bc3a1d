"""Small frames with zone-free times, and plain rows back."""

from datetime import datetime, timedelta

T0 = datetime(2025, 4, 1)


def at(seconds=0, **kw):
    return T0 + timedelta(seconds=seconds, **kw)


def rows(df, *order):
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=repr)
