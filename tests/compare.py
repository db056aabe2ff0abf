"""Run queries next to their SQL twins and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def close(a, b) -> bool:
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return abs(a - b) <= 2e-5 * max(1.0, abs(a))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    return a == b


def differences(df, con, sql) -> list[str]:
    result = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in result.description}
    want = rows_of([d[0] for d in result.description], result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if got[0] != want[0]:
        return [f"columns {got[0]} != {want[0]}"]
    alike = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, spark_type in df.dtypes:
        if spark_type in alike and alike[spark_type] != want_types[name]:
            problems.append(f"type of {name}: {spark_type} != {want_types[name]}")
    if len(got[1]) != len(want[1]):
        problems.append(f"rows {len(got[1])} != {len(want[1])}")
    exact = sum(g == w for g, w in zip(got[1], want[1]))
    bad = [(g, w) for g, w in zip(got[1], want[1]) if not close(g, w)]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    elif exact < len(got[1]):
        problems.append(f"note: {len(got[1]) - exact} rows equal only within rounding")
    if not got[1]:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from conceptlink.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    twins = oracle_sql()
    for name, run in queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = run(spark, sf_dir)
            if name in twins:
                problems = differences(df, con, twins[name])
                print(f"{'ok  ' if not problems else 'DIFF'} {name} {time.time() - t0:.1f}s {'; '.join(problems)[:600]}", flush=True)
            else:
                rows = df.collect()
                print(f"rows {name} {time.time() - t0:.1f}s n={len(rows)} {rows[:2]}"[:400], flush=True)
        except Exception as e:
            print(f"FAIL {name} {time.time() - t0:.1f}s {type(e).__name__}: {str(e)[:700]}", flush=True)
