"""Run registered queries on Spark and their SQL on DuckDB, and compare names, types and values.

    python -m tests.oracle_check [--sf DIR] [key-prefix ...]
"""

import argparse
import math
import sys
import time
import traceback

import duckdb
import pyarrow as pa

TABLE_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def kind(t):
    if pa.types.is_decimal(t):
        return f"decimal{t.scale}"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_large_string(t) or pa.types.is_string(t) or pa.types.is_string_view(t):
        return "string"
    return str(t)


def canon(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        v = v.replace(tzinfo=None)
    return str(v)


def rows(table):
    names = sorted(table.column_names)
    cols = [[canon(v) for v in table[n].to_pylist()] for n in names]
    return sorted(zip(*cols)) if cols else []


def compare(df, sql, con):
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns differ: {sorted(set(got.column_names) ^ set(want.column_names))}", got.num_rows
    types = [(n, kind(got.schema.field(n).type), kind(want.schema.field(n).type)) for n in got.column_names]
    bad_types = [t for t in types if t[1] != t[2]]
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; types {bad_types}", got.num_rows
    if a != b:
        names = sorted(got.column_names)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        cols = sorted({names[i] for x, y in diff for i in range(len(x)) if x[i] != y[i]})
        first = [{n: (p, q) for n, p, q in zip(names, x, y) if p != q} for x, y in diff[:2]]
        return f"{len(diff)} of {len(a)} rows differ in {cols}: {first}; types {bad_types}", got.num_rows
    if bad_types:
        return f"types differ {bad_types}", got.num_rows
    return None, got.num_rows


def main():
    sys.path.insert(0, ".")
    import __spark_entry__ as entry_module
    from tallyspark.session import build_session
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--exact", action="store_true")
    parser.add_argument("--match", default="")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    keys = [k for k in queries if (not args.keys or k in args.keys or (not args.exact and any(k.startswith(p) for p in args.keys)))]
    if args.match:
        import re
        keys = [k for k in keys if re.search(args.match, k)]
    bad, total = 0, time.time()
    for k in keys:
        t0 = time.time()
        try:
            df = queries[k](spark, args.sf)
            if k in oracles:
                problem, n = compare(df, oracles[k], con)
            else:
                t = df.toArrow()
                problem, n = None, t.num_rows
        except Exception as e:
            problem, n = "ERROR " + (str(e) or traceback.format_exc())[:700], -1
        bad += problem is not None
        mark = "FAIL" if problem else ("ok" if k in oracles else "rows")
        print(f"{mark:5} {k:34} rows={n:<8} {time.time() - t0:5.1f}s {problem or ''}", flush=True)
    print(f"{len(keys)} queries, {bad} bad, {time.time() - total:.0f}s")


if __name__ == "__main__":
    main()
