import datetime as dt
import decimal
import math
from collections import Counter


def _norm(v):
    if v is None:
        return None
    try:
        if v != v or str(v) == "NaT":  # NaN / NaT are NULL
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):  # pandas Timestamp included
        v = v.replace(tzinfo=None)
        if v.hour == v.minute == v.second == v.microsecond == 0:
            return v.date()
        return v
    if hasattr(v, "to_pydatetime"):
        return norm(v.to_pydatetime()) if "norm" in globals() else _norm(v.to_pydatetime())
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def as_multiset(pdf):
    cols = sorted(pdf.columns)
    return cols, Counter(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


def rows(df, *cols):
    """Collect a small test DataFrame as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
