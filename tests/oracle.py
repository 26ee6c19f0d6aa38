"""Compare registered queries with their SQL twins on DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    return v


def difference(spark, con, name, build, sql, folder) -> str | None:
    """None when schema and rows agree exactly, otherwise a description."""
    df = build(spark, folder)
    cols = sorted(df.columns)
    mine = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    cur = con.execute(sql)
    their_cols = [d[0] for d in cur.description]
    if sorted(their_cols) != cols:
        return f"{name}: columns {cols} != {sorted(their_cols)}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    for f in df.schema.fields:
        want = TYPES.get(f.dataType.simpleString())
        if want != kinds[f.name]:
            return f"{name}: {f.name} is {f.dataType.simpleString()} here, {kinds[f.name]} there"
    order = [their_cols.index(c) for c in cols]
    theirs = [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]
    if len(mine) != len(theirs):
        return f"{name}: {len(mine)} rows here, {len(theirs)} there"
    mine.sort(key=_key)
    theirs.sort(key=_key)
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
        return f"{name}: {len(bad)}/{len(mine)} rows differ, first {cells[:6]}"
    if not mine:
        return f"{name}: no rows on either side"
    return None


def main(folder: str, only: list[str]) -> int:
    from depotflow import registry
    from depotflow.session import build_session

    spark = build_session(
        "oracle", spark__master="local[8]", spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    twins = registry.oracle_sql()
    for name, build in registry.queries().items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            if name in twins:
                text = difference(spark, con, name, build, twins[name], folder)
            else:
                text = f"{name}: rows only, {build(spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            text = f"{name}: {type(error).__name__} {str(error)[:900]}"
        failed += bool(text) and "rows only" not in text
        print(f"{'ok ' if not text else 'BAD'} {name} {time.time() - start:.2f}s {text or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
