"""Order-free comparison of a Spark result with a DuckDB result."""

import glob
import math
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, (bool,)):
        return str(value).lower()
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return repr(value if value != int(value) or abs(value) > 1e15 else int(value))
    return str(value)


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)]
    rows = sorted(
        tuple(_cell(v) for v in row) for row in pdf.astype(object).itertuples(index=False)
    )
    return list(pdf.columns), rows


def same(left, right):
    lc, lr = canonical(left)
    rc, rr = canonical(right)
    assert lc == rc, f"columns {lc} != {rc}"
    assert len(lr) == len(rr), f"rows {len(lr)} != {len(rr)}"
    wrong = [(a, b) for a, b in zip(lr, rr, strict=True) if a != b]
    assert not wrong, f"{len(wrong)} rows differ, first {wrong[0]}"
