"""Compare a Spark result with the DuckDB result of its SQL twin. Also a small command."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "int": "INTEGER",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def differences(frame, con, sql: str) -> list[str]:
    """Empty if columns, types and the multiset of rows agree."""
    relation = con.sql(sql)
    ours = dict(frame.dtypes)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} != {sorted(theirs)}"]
    out = [
        f"type of {c}: {k} / {theirs[c]}" for c, k in ours.items() if KINDS.get(k, k) != theirs[c]
    ]
    names = sorted(ours)
    a = sorted((tuple(r[c] for c in names) for r in frame.collect()), key=_key)
    at = [relation.columns.index(c) for c in names]
    b = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=_key)
    if len(a) != len(b):
        return [*out, f"rows {len(a)} != {len(b)}"]
    wrong = [(x, y) for x, y in zip(a, b) if not _same(x, y)]
    if wrong:
        out.append(f"{len(wrong)} of {len(a)} rows differ, first {names}: {wrong[0]}")
    return out


def _same(x, y) -> bool:
    for u, v in zip(x, y):
        if isinstance(u, float) and isinstance(v, float) and math.isnan(u) and math.isnan(v):
            continue
        if u != v:
            return False
    return True


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from vetrail.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), oracle_sql()
    for name, q in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                found = differences(q(spark, sf_dir), con, sqls[name])
            else:
                found = [f"no SQL; {q(spark, sf_dir).count()} rows"]
        except Exception as e:  # noqa: BLE001 - report and go on
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        print(f"{name:26s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
