"""Runs registered queries against their checking SQL: python tests/check_queries.py SF_DIR [name ...]."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(spark, con, build, sql: str, sf_dir: str) -> tuple[str, int]:
    df = build(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=sort_key)
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} != {sorted(rel.columns)}", len(got)
    order = [rel.columns.index(n) for n in names]
    kinds = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    want = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=sort_key)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(got)
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: spark {a} / sql {b} ({kinds})", len(got)
    pairs = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema]
    expected = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = [p for p in pairs if expected.get(p[1]) != p[2]]
    return (f"ok, types differ {odd}" if odd else "ok"), len(got)


def main() -> None:
    import __spark_entry__ as driver
    from lodewatch.session import local_session

    sf_dir = sys.argv[1]
    spark = local_session(8)
    con = connect(sf_dir)
    registered, oracle = driver.queries(), driver.oracle_sql()
    names = sys.argv[2:] or list(registered)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                verdict, rows = compare(spark, con, registered[name], oracle[name], sf_dir)
            else:
                verdict, rows = "rows only", len(registered[name](spark, sf_dir).collect())
        except Exception as e:  # report and go on with the next query
            verdict, rows = "ERROR " + str(e)[:600].replace("\n", " "), -1
        bad += not (verdict == "ok" or verdict == "rows only")
        print(f"{name:36s} {time.time() - start:6.1f}s {rows:8d} {verdict}", flush=True)
    print("not ok:", bad)


if __name__ == "__main__":
    main()
