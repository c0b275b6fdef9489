import math


def canon(v):
    if v is None:
        return "NULL"      # sorts with text
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "item"):
        return canon(v.item())
    return repr(v)


def rows_of(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
