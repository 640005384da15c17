"""Run a catalogue query and its SQL on the same folder and compare the results.

``python -m tests.compare FOLDER [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cut = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(cut, key=repr)


def difference(spark_frame, con, sql: str) -> str | None:
    """None if both sides agree, else the first difference."""
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER"}
    names, left = _rows(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    other, right = _rows([d[0] for d in result.description], result.fetchall())
    if names != other:
        return f"columns {names} against {other}"
    for name, kind in spark_frame.dtypes:
        wanted = kinds.get(kind, kind.upper())
        if types[name] not in (wanted, "STRING" if wanted == "VARCHAR" else wanted):
            return f"type of {name}: {kind} against {types[name]}"
    if len(left) != len(right):
        only = set(left) ^ set(right)
        return f"rows {len(left)} against {len(right)}, e.g. {sorted(only, key=repr)[:2]}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} against {b}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from amperline.session import local_session

    spark, con = local_session(8), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in oracle:
                found = difference(frame, con, oracle[name])
            else:
                found = f"no SQL, {frame.count()} rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            found = f"{type(error).__name__}: {str(error)[:700]}"
        ok = found is None or found.startswith("no SQL")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
