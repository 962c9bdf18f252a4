"""Run registered queries on Spark and their SQL on DuckDB; compare as multisets of rows.

    python tests/oracle.py [--sf DIR] [name-part ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.12g}")
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, query, sql) -> tuple[str | None, int]:
    """None when both sides agree, else what differs; and the number of rows."""
    df = query(spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    n = sum(got.values())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}", n
    kinds = {d[0]: str(d[1]) for d in result.description}
    for name, dtype in df.dtypes:
        if TYPES.get(dtype) != kinds[name]:
            return f"type of {name}: {dtype} against {kinds[name]}", n
    if got != expected:
        more, less = list((got - expected).items())[:3], list((expected - got).items())[:3]
        return f"{n} rows against {sum(expected.values())}; only Spark {more}; only SQL {less}", n
    return None, n


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from harborline.session import session

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark = session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                    spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracle, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv and not any(a in name for a in argv):
            continue
        start = time.time()
        try:
            if name in oracle:
                problem, n = compare(spark, con, sf, query, oracle[name])
            else:
                problem, n = None, query(spark, sf).count()
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:34} {n:7} rows {time.time() - start:6.2f}s{'' if name in oracle else ' (no SQL)'} {problem or ''}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
