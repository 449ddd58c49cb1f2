"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_conn(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    msgs = []
    if sorted(spark_cols) != sorted(duck_cols):
        msgs.append(f"columns differ: spark={spark_cols} duck={duck_cols}")
        return msgs
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        msgs.append(f"row count spark={len(a)} duck={len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        msgs.append(f"{len(bad)} rows differ; first: spark={bad[0][0]} duck={bad[0][1]}")
    return msgs


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from shoplens.session import get_spark
    import __spark_entry__ as entry
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck_conn(sf_dir)
    failures = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            failures += 1
            continue
        t1 = time.time()
        if name not in sql:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {t1 - t0:.2f}s")
            continue
        try:
            res = con.execute(sql[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            failures += 1
            continue
        msgs = compare(srows, scols, drows, dcols)
        stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        dtypes = {d[0]: str(d[1]) for d in res.description}
        tmap = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER"}
        tdiff = [f"{c}:{stypes[c]}/{dtypes.get(c)}" for c in stypes
                 if tmap.get(stypes[c], stypes[c]) != dtypes.get(c)]
        if tdiff:
            msgs.append("types differ " + ",".join(tdiff))
        status = "OK  " if not msgs else "FAIL"
        failures += bool(msgs)
        print(f"{status} {name}: {len(srows)} rows spark {t1 - t0:.2f}s " + "; ".join(msgs))
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
