"""Run a registered query and its SQL counterpart on the same tables and compare the rows."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v)
    if isinstance(v, Decimal):
        return str(v)
    return repr(v)


def rows_of(cols, rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns and rows agree."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    kinds = {"LONG": "BIGINT", "INT": "INTEGER", "STRING": "VARCHAR", "TIMESTAMP_NTZ": "TIMESTAMP"}
    theirs = {d[0]: str(d[1]).upper() for d in cur.description}
    for name, kind in df.dtypes:
        kind = kinds.get(kind.upper(), kind.upper())
        if name in theirs and kind != theirs[name]:
            out.append(f"type of {name}: {kind} vs {theirs[name]}")
    if len(got) != len(want):
        out.append(f"{len(got)} rows vs {len(want)}")
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    if only_got or only_want:
        out.append(f"{len(only_got)} only in Spark {only_got[:2]}; {len(only_want)} only in SQL {only_want[:2]}")
    if not got:
        out.append("no rows")
    return out


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from beaconry.session import get_session

    root = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session("compare", "local[8]", **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(root)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracle:
                diff = differences(fn(spark, root), con, oracle[name])
            else:
                diff = [] if fn(spark, root).collect() else ["no rows"]
        except Exception as exc:  # report and go on
            diff = [f"{type(exc).__name__}: {str(exc)[:700]}"]
        bad += bool(diff)
        mark = "FAIL" if diff else ("ok" if name in oracle else "ok (rows only)")
        print(f"{name:28s} {time.time() - start:6.1f}s {mark}", *diff, sep="\n    " if diff else " ", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
