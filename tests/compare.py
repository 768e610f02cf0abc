"""Run catalogue queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, text, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    res = con.execute(text)
    names = [d[0] for d in res.description]
    kinds = {d[0]: str(d[1]) for d in res.description}
    want = res.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(set(df.columns) ^ set(names))}")
    else:
        a, b = rows_of(df.columns, got), rows_of(names, want)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            problems.append(f"rows {len(a)} vs {len(b)}, e.g. {diff}")
        types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
        odd = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields
               if types.get(f.dataType.simpleString()) != kinds[f.name]]
        if odd:
            problems.append(f"types {odd}")
    return len(got), t1 - t0, problems


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from roadpulse.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                                "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), oracle_sql()
    for name, fn in queries().items():
        if only and name not in only:
            continue
        try:
            if name not in sqls:
                print(f"{name:24s} no sql, {fn(spark, sf_dir).count()} rows", flush=True)
                continue
            n, secs, problems = compare(spark, con, name, fn, sqls[name], sf_dir)
            print(f"{name:24s} {n:7d} rows {secs:6.2f}s {'ok' if not problems else 'DIFF ' + '; '.join(problems)[:600]}", flush=True)
        except Exception as e:  # noqa: BLE001 - report and go on
            print(f"{name:24s} ERROR {type(e).__name__} {str(e)[:700]}", flush=True)
