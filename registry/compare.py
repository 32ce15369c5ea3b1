"""Run a registered query and its SQL and report how they differ."""

from __future__ import annotations

from registry.base import ORACLES, QUERIES

# Spark type name -> DuckDB type name
SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def differences(spark, db, name: str, sf_dir: str) -> tuple[int, list[str]]:
    """(row count, problems); without SQL only the row count is known."""
    df = QUERIES[name](spark, sf_dir)
    types = dict(df.dtypes)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return len(got), []
    res = db.execute(ORACLES[name])
    want_types = {c[0]: str(c[1]) for c in res.description}
    names = list(want_types)
    want = res.fetchall()
    if sorted(types) != sorted(names):
        return len(got), [f"columns {sorted(types)} vs {sorted(names)}"]
    off = [(c, t, want_types[c]) for c, t in types.items() if SAME.get(t) != want_types[c]]
    problems = [f"types {off}"] if off else []
    order, mine = sorted(types), list(types)
    a = sorted(tuple(map(repr, (r[mine.index(c)] for c in order))) for r in got)
    b = sorted(tuple(map(repr, (r[names.index(c)] for c in order))) for r in want)
    if a != b:
        extra, lost = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        problems.append(
            f"{len(a)} vs {len(b)} rows, {order}\n   spark only {extra}\n   duckdb only {lost}"
        )
    return len(got), problems
