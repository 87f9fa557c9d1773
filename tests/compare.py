"""Run registered queries beside their SQL: ``python tests/compare.py [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, cells as text."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = ["NULL" if pd.isna(v) else _cell(v) for v in df[c]]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def _cell(value) -> str:
    if isinstance(value, (bool, np.bool_)):
        return str(value)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    try:
        return repr(float(value)) if not isinstance(value, str) else value
    except (TypeError, ValueError):
        return str(value)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _canonical(got), _canonical(want)
    wrong = (a != b).any(axis=1)
    if not wrong.any():
        return None
    rows = pd.concat([a[wrong].head(3), b[wrong].head(3)], keys=["spark", "sql"])
    return f"{int(wrong.sum())} rows differ\n{rows.to_string()}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from conftest import make_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = make_session()
    con = connect(sf_dir)
    oracles = oracle_sql()
    failed = 0
    for name in sys.argv[1:] or queries():
        started = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            got = df.toPandas()
            spent = time.time() - started
            if name not in oracles:
                print(f"rows {name} {len(got)} {spent:.1f}s", flush=True)
                continue
            relation = con.sql(oracles[name])
            types = dict(zip(relation.columns, map(str, relation.types)))
            ours = dict(df.dtypes)
            problem = difference(got, relation.df())
            odd = {c: (t, types.get(c)) for c, t in ours.items() if not _alike(t, types.get(c))}
            print("FAIL" if problem else "ok  ", name, len(got), f"{spent:.1f}s", problem or "", odd or "", flush=True)
            failed += bool(problem)
        except Exception as err:  # report and go on to the next query
            failed += 1
            print("FAIL", name, type(err).__name__, str(err)[:1500], flush=True)
    spark.stop()
    return failed


ALIKE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def _alike(ours: str, theirs: str | None) -> bool:
    return ALIKE.get(ours) == theirs


if __name__ == "__main__":
    sys.exit(main())
