"""Run registered queries against their DuckDB oracles (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query and a JSON summary on the last line.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemark.sources.fixtures import TABLES  # noqa: E402


def _norm(v, digits=None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is not None:
            return float(f"{v:.{digits}g}")
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return float(v)
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_SPARK_TO_DUCK = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def type_mismatches(spark_schema, duck_res) -> list[str]:
    duck = {d[0]: str(d[1]) for d in duck_res.description}
    out = []
    for f in spark_schema.fields:
        want = _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck.get(f.name)
        if got is not None and got != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} / duck {got}")
    return out


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return "schema", f"{sorted(spark_cols)} != {sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return "rows", f"{len(spark_rows)} != {len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    exact_s = Counter(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    exact_d = Counter(tuple(_norm(r[i]) for i in di) for r in duck_rows)
    if exact_s == exact_d:
        return "ok", ""
    loose_s = Counter(tuple(_norm(r[i], 12) for i in si) for r in spark_rows)
    loose_d = Counter(tuple(_norm(r[i], 12) for i in di) for r in duck_rows)
    diff = list((exact_s - exact_d).items())[:3]
    if loose_s == loose_d:
        return "close", f"differs beyond 12 digits, e.g. {diff}"
    return "values", f"e.g. spark-only {diff} duck-only {list((exact_d - exact_s).items())[:3]}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tidemark.session import get_session

    spark = get_session(shuffle_partitions=8)
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    summary = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            summary[name] = "spark-error"
            print(f"{name:40s} SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        t1 = time.time()
        if name not in oracles:
            summary[name] = "rows-only"
            print(f"{name:40s} rows-only {len(rows)} rows  spark {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(oracles[name])
            dcols = [d[0] for d in res.description]
            types = type_mismatches(df.schema, res)
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            summary[name] = "sql-error"
            print(f"{name:40s} SQL ERROR {str(e)[:400]}")
            continue
        status, msg = compare(rows, cols, drows, dcols)
        if status == "ok" and types:
            status, msg = "types", "; ".join(types)
        summary[name] = status
        print(f"{name:40s} {status:7s} {len(rows)} rows  spark {t1 - t0:.1f}s  {msg[:600]}")
    print(json.dumps(summary))


if __name__ == "__main__":
    main(sys.argv)
