"""Compare a query with its DuckDB statement, by value and by column type."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Column type families that both engines must agree on.
FAMILIES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
            "BOOLEAN": "boolean"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9) or (math.isnan(a) and math.isnan(b))
    return a == b


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences; empty when the results agree."""
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    columns = sorted(df.columns)
    if columns != sorted(types):
        return [f"columns {columns} vs {sorted(types)}"]
    out = []
    for field in df.schema.fields:
        want = FAMILIES.get(types[field.name], types[field.name])
        if field.dataType.simpleString() != want:
            out.append(f"type of {field.name}: {field.dataType.simpleString()} vs {want}")
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    if len(mine) != len(theirs):
        out.append(f"rows {len(mine)} vs {len(theirs)}")
    bad = [(a, b) for a, b in zip(mine, theirs) if not all(map(_same, a, b))]
    for a, b in bad[:2]:
        out.append("; ".join(f"{c}: {x!r} vs {y!r}" for c, x, y in zip(columns, a, b)
                             if not _same(x, y)))
    if bad:
        out.append(f"{len(bad)} rows differ")
    return out
