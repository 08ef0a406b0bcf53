"""Row-by-row comparison of a registered query with its SQL counterpart."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def differences(frame, con, sql: str) -> str | None:
    """None when columns and rows agree, else a short account of what differs."""
    cur = con.execute(sql)
    theirs = _table([d[0] for d in cur.description], cur.fetchall())
    ours = _table(frame.columns, [tuple(r) for r in frame.collect()])
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        only_ours = sorted(set(ours[1]) - set(theirs[1]))[:3]
        only_theirs = sorted(set(theirs[1]) - set(ours[1]))[:3]
        return f"rows {len(ours[1])} vs {len(theirs[1])}; ours {only_ours}; theirs {only_theirs}"
    if not ours[1]:
        return "no rows"
    return None
