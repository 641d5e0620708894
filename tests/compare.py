"""Compare a Spark result with a DuckDB result as bags of rows."""

from __future__ import annotations

from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    return value + 0.0 if isinstance(value, float) else value


def differences(df, con, sql: str) -> str:
    """Empty if names, types and rows agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]}
    if wrong:
        return f"types {wrong}"
    expected = bag(names, cursor.fetchall())
    actual = bag(df.columns, df.collect())
    if actual == expected:
        return ""
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only Spark {list(extra)[:3]}; only DuckDB {list(missing)[:3]}"
    )
