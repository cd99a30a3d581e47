"""Order-insensitive comparison of a Spark result with its DuckDB twin."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB names of the Spark types results may have.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def mismatch(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    described = con.execute(f"describe {sql}").fetchall()
    theirs = {r[0]: r[1] for r in described}
    ours = {
        f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        for f in spark_df.schema
    }
    if set(ours) != set(theirs):
        return f"columns: {sorted(set(ours) ^ set(theirs))}"
    wrong = {n: (ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]}
    if wrong:
        return f"types: {wrong}"
    names = sorted(ours)
    got = Counter(tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect())
    columns = ", ".join(f'"{n}"' for n in names)
    want = Counter(con.execute(f"select {columns} from ({sql})").fetchall())
    if got != want:
        extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
        return (
            f"rows: {sum(got.values())} vs {sum(want.values())}\n{names}\n"
            f"only Spark: {extra}\nonly DuckDB: {lost}"
        )
    return None
