"""Run queries in Spark and DuckDB and compare columns, types, row counts and values."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# DuckDB types that agree with a Spark type.
SAME = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "smallint": {"SMALLINT", "UTINYINT"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "float": {"FLOAT"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{files}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences, empty when both agree."""
    problems = []
    described = [(c[0], c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()]
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = dict(described)
    if set(spark_types) != set(duck_types):
        return [f"columns {sorted(spark_types)} != {sorted(duck_types)}"]
    for name, kind in spark_types.items():
        if duck_types[name] not in SAME.get(kind, set()):
            problems.append(f"type of {name}: {kind} != {duck_types[name]}")
    cols = sorted(spark_types)
    ours = collections.Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    place = [[d[0] for d in described].index(c) for c in cols]
    theirs = collections.Counter(tuple(plain(r[i]) for i in place) for r in con.execute(sql).fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        problems.append(
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; only Spark {sum(extra.values())} "
            f"{list(extra)[:3]}; only DuckDB {sum(missing.values())} {list(missing)[:3]}"
        )
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and not any(n == name or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            found = compare(df, con, sqls[name]) if name in sqls else [] if df.count() else ["no rows"]
            note = "" if name in sqls else f"(rows only: {df.count()})"
        except Exception as e:  # noqa: BLE001
            found, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s {note}", *found, sep="\n     " if found else " ", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
