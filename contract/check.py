"""Compare registered queries with their oracle: ``python -m contract.check DIR [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb

from candlewick import build_session
from contract.queries import REGISTRY


def oracle(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark, con, name: str, sf: str) -> str | None:
    run, sql = REGISTRY[name]
    df = run(spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = _rows(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    if not bad:
        return None
    g, w = bad[0]
    cols = sorted(names)
    cells = [f"{c}: {a!r} / {b!r}" for c, a, b in zip(cols, g, w, strict=True) if a != b]
    return f"{len(bad)} of {len(got)} rows differ; {'; '.join(cells[:4])}"


def main() -> None:
    sf, only = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = oracle(sf), []
    for name in only or list(REGISTRY):
        start = time.time()
        try:
            problem = difference(spark, con, name, sf)
        except Exception as error:
            text = str(error).strip().splitlines()
            problem = f"{type(error).__name__}: {' '.join(text[:3])[:400]}"
            if only:
                traceback.print_exc()
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}")
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
