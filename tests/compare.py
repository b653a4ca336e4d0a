"""Exact comparison of a query's rows with its SQL, independent of row and column order."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def differences(frame, con, sql) -> list[str]:
    """Human-readable differences; an empty list means equal."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(set(frame.columns) ^ set(names))}"]
    got = [tuple(row) for row in frame.collect()]
    if len(got) != len(expected):
        return [f"rows {len(got)} != {len(expected)}"]
    a, b = canonical(got, frame.columns), canonical(expected, names)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    cols = sorted(names)
    out = []
    if wrong:
        out.append(f"{len(wrong)} of {len(a)} rows differ")
        for x, y in wrong[:3]:
            out.append(str([(c, p, q) for c, p, q in zip(cols, x, y) if p != q][:6]))
    kinds = dict(zip(names, (str(d[1]) for d in found.description)))
    for f in frame.schema.fields:
        want = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}.get(kinds[f.name].upper())
        if want != f.dataType.simpleString():
            out.append(f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}")
    return out
