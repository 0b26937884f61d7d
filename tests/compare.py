"""Compare a query's rows with those of its SQL in DuckDB."""

import math
import os

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if v is None or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(value(x) for x in v)
    if isinstance(v, (float, np.floating)):
        return round(float(v), 6)
    return v.item() if isinstance(v, np.generic) else v


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted((tuple(value(v) for v in r) for r in frame[columns].itertuples(index=False, name=None)), key=repr)


def oracle(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con.execute(sql).df()
