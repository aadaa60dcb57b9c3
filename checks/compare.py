"""Run every query and its SQL on one scale and compare rows: python -m checks.compare sf_dir [names]."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    plain = lambda v: None if v is None or (not isinstance(v, str) and pd.isna(v)) else v
    number = lambda v: round(float(v), 6) + 0.0 if isinstance(v, (int, float)) or hasattr(v, "dtype") else v
    rows = [tuple(None if plain(v) is None else number(v) for v in r) for r in frame[columns].itertuples(index=False)]
    return sorted(rows, key=repr)


def kinds(frame: pd.DataFrame) -> dict:
    return {c: str(t) for c, t in sorted(frame.dtypes.items())}


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    g, w = rows_of(got), rows_of(want)
    if len(g) != len(w):
        return f"{len(g)} and {len(w)} rows"
    wrong = [(x, y) for x, y in zip(g, w) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}"[:1500] if wrong else None


def main(argv: list[str]) -> int:
    from storyloom.session import build_session

    sf_dir = argv[0]
    names = argv[1:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in ORACLES:
                print(f"{name}: {len(got)} rows, no SQL, {took:.1f}s", flush=True)
                continue
            want = con.execute(ORACLES[name]).df()
            problem = difference(got, want)
            if not problem and kinds(got) != kinds(want):
                print(f"  {name}: types {kinds(got)} and {kinds(want)}")
        except Exception as e:  # noqa: BLE001 - the report names every failing query
            took, problem = time.time() - start, f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{name}: {'DIFFERS ' + problem if problem else f'same, {len(got)} rows'}, {took:.1f}s", flush=True)
    print(f"{failed} of {len(names)} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
