"""Compare a registered query with its SQL oracle in DuckDB."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def type_name(t: str) -> str:
    return {
        "integer": "INTEGER", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR",
        "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
        "timestamp": "TIMESTAMP",
    }.get(t, t)


def differences(con, df, sql: str) -> list[str]:
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    types = {c[0]: str(c[1]) for c in res.description}
    want = rows_of(names, res.fetchall())
    out = []
    if got[0] != want[0]:
        return [f"columns {got[0]} != {want[0]}"]
    for name, kind in df.dtypes:
        if type_name(kind) != types[name]:
            out.append(f"type of {name}: {kind} != {types[name]}")
    if len(got[1]) != len(want[1]):
        out.append(f"rows {len(got[1])} != {len(want[1])}")
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]))[:3]
        missing = sorted(set(want[1]) - set(got[1]))[:3]
        out.append(f"{got[0]}: only spark {extra}; only sql {missing}")
    return out


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from ludomart.catalog import ORACLE, QUERIES
    from ludomart.session import get_spark

    sf = sys.argv[1]
    spark = get_spark(
        master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        t = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLE:
                diff = differences(con, df, ORACLE[name])
            else:
                diff = [f"no oracle, {df.count()} rows"]
        except Exception as e:  # report and go on with the next query
            diff = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(diff)
        print(f"{name:26s} {time.time() - t:6.2f}s {'ok' if not diff else ' | '.join(diff)}", flush=True)
    print("not equal:", bad)
