"""Compare catalog queries with their SQL counterparts.

usage: check_oracle.py SF_DIR [name ...]   (names starting with - are left out)
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textcheck.plans.catalog import REGISTRY  # noqa: E402
from textcheck.plans.oracles import ORACLES  # noqa: E402
from textcheck.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in one order."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if frame[name].dtype.kind == "f":
            frame[name] = frame[name].round(6) + 0.0
    keys = frame.astype(str).agg("|".join, axis=1) if len(frame.columns) else None
    return frame.iloc[keys.argsort(kind="stable")].reset_index(drop=True) if len(frame) else frame


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = normal(got), normal(want)
    for name in got.columns:
        a, b = got[name], want[name]
        if (a.dtype.kind in "iufb") and (b.dtype.kind in "iufb"):
            same = (a.astype(float) - b.astype(float)).abs().fillna(0) == 0
            same &= a.isna() == b.isna()
        else:
            same = (a.astype(str) == b.astype(str)) | (a.isna() & b.isna())
        if not same.all():
            i = (~same).to_numpy().nonzero()[0]
            return f"{name}: {len(i)} rows, first {str(a[i[0]])[:300]!r} != {str(b[i[0]])[:300]!r}"
        # A nullable integer column arrives as float from one side.
        if a.dtype.kind != b.dtype.kind and not (a.isna().any() or b.isna().any()):
            return f"{name}: types {a.dtype} != {b.dtype}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    skip = {n[1:] for n in names if n.startswith("-")}
    chosen = [n for n in names if not n.startswith("-")] or [n for n in REGISTRY if n not in skip]
    failed = []
    for name in chosen:
        start = time.time()
        try:
            got = REGISTRY[name](spark, sf_dir).toPandas()
            took = time.time() - start
            start = time.time()
            if name in ORACLES:
                want = connection.execute(ORACLES[name]).df()
                problem = difference(got, want)
                verdict = "ok" if problem is None else f"DIFF {problem}"
            else:
                verdict = "rows only"
            oracle_took = time.time() - start
        except Exception as error:  # noqa: BLE001
            verdict, got, took, oracle_took = f"ERROR {str(error)[:600]}", [], time.time() - start, 0
        if verdict.startswith(("DIFF", "ERROR")):
            failed.append(name)
        print(f"{name:32} {took:6.1f}s {oracle_took:6.1f}s {len(got):7} {verdict}", flush=True)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
