"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def compare(spark_df, cursor) -> list[str]:
    """Differences as text lines; empty when columns, types and values agree."""
    theirs = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]).upper() for d in cursor.description}
    ours = spark_df.columns
    if sorted(ours) != sorted(theirs):
        return [f"columns differ: {sorted(ours)} / {sorted(theirs)}"]
    wanted = {"bigint": ("BIGINT", "INTEGER", "HUGEINT"), "double": ("DOUBLE",), "string": ("VARCHAR",),
              "boolean": ("BOOLEAN",), "timestamp": ("TIMESTAMP",), "date": ("DATE",)}
    problems = [f"type of {c}: {t} / {types[c]}" for c, t in spark_df.dtypes if types[c] not in wanted.get(t, (t,))]
    cells = lambda rows, cols: sorted(
        (tuple(_cell(r[i]) for i in sorted(range(len(cols)), key=lambda i: cols[i])) for r in rows), key=_key)
    mine, other = cells([tuple(r) for r in spark_df.collect()], ours), cells(cursor.fetchall(), theirs)
    if len(mine) != len(other):
        problems.append(f"rows: {len(mine)} / {len(other)}")
    bad = [(a, b) for a, b in zip(mine, other) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, columns {sorted(ours)}")
        problems += [f"  spark  {a}\n  duckdb {b}" for a, b in bad[:3]]
    return problems


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con
