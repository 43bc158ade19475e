"""Compare a registered query with its SQL check, as sorted rows with columns ordered by name."""

from __future__ import annotations

import math
import re
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check_plan(df) -> None:
    """No cross join, no Python per row, no window over a whole table."""
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    for window in re.findall(r"Window \[.*", plan):
        assert "windowspecdefinition(" in window and not re.search(r"windowspecdefinition\([^,]* (ASC|DESC)", window)


def compare(spark, con, query, sf_dir: str, plan: bool = False) -> str | None:
    """None when equal, else what differs; with ``plan`` the physical plan is looked at too."""
    df = query.run(spark, sf_dir)
    if plan:
        check_plan(df)
    got_names, got = _sorted(df.columns, df.collect())
    # A check must also hold as a view, as the driver may keep it.
    con.execute(f"CREATE OR REPLACE VIEW checked AS {query.sql}")
    rel = con.execute("SELECT * FROM checked")
    want_names, want = _sorted([d[0] for d in rel.description], rel.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[:2]}"
    types = [(n, type(g), type(w)) for n, g, w in zip(got_names, got[0], want[0]) if g is not None and type(g) is not type(w)] if got else []
    return f"types {types}" if types else None
