"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/compare.py [sf_dir] [name ...]
Reports row count, column names/types and an order-insensitive value check.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(t: str) -> str:
    t = t.lower()
    if any(x in t for x in ("[]", "array", "list")):
        return "list"
    if any(x in t for x in ("int", "long", "short", "byte")):
        return "int"
    if any(x in t for x in ("double", "float", "real", "decimal")):
        return "float"
    if any(x in t for x in ("char", "string", "varchar")):
        return "str"
    if "bool" in t:
        return "bool"
    return t


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def compare(spark, con, name: str, sf_dir: str):
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return {"name": name, "status": "no-oracle", "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res = {"name": name, "rows": (len(s_rows), len(d_rows)), "spark_s": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        res.update(status="COLUMNS", spark=s_cols, duck=d_cols)
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    dorder = [d_cols.index(s_cols[i]) for i in order]
    sk = [_kind(s_types[i]) for i in order]
    dk = [_kind(d_types[i]) for i in dorder]
    type_note = None if sk == dk else list(zip([s_cols[i] for i in order], [s_types[i] for i in order],
                                               [d_types[i] for i in dorder]))
    srows = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=repr)
    drows = sorted((tuple(_norm(r[i]) for i in dorder) for r in d_rows), key=repr)
    exact = sorted((tuple(r[i] for i in order) for r in s_rows), key=repr) == \
        sorted((tuple(r[i] for i in dorder) for r in d_rows), key=repr)
    if srows == drows:
        res["status"] = "OK" if type_note is None else "OK-TYPES"
    else:
        res["status"] = "VALUES"
        diff = [x for x in srows if x not in set(drows)][:3]
        res["spark_only"] = diff
        res["duck_only"] = [x for x in drows if x not in set(srows)][:3]
    res["exact"] = exact
    if type_note:
        res["types"] = type_note
    return res


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf_dir, argv = argv[0], argv[1:]
    from __spark_entry__ import queries
    from tessera.session import get_spark
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    names = argv or list(queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": repr(e)[:600]}
        if r["status"] not in ("OK", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
