"""Compare queries with their SQL in DuckDB: ``python -m tests.oracle [folder] [name …]``."""

import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark, con, build, sql: str, folder: str, may_be_empty: bool = False) -> str | None:
    """None when equal, else what differs."""
    frame = build(spark, folder)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    for name, kind in zip(names, [str(d[1]) for d in result.description]):
        if same.get(kinds[name], kind) not in (kind, "STRING" if kind == "VARCHAR" else kind):
            return f"type of {name}: {kinds[name]} and {kind}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, frame.collect())
    if actual == expected:
        return None if actual or may_be_empty else "no rows"
    missing = [r for r in expected if r not in set(actual)][:3]
    extra = [r for r in actual if r not in set(expected)][:3]
    return f"{len(actual)} and {len(expected)} rows; only in SQL {missing}; only in Spark {extra}"


def main() -> None:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from weftwork.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(folder), oracle_sql(), []
    for name in chosen:
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, queries()[name], sqls[name], folder)
            else:
                problem = None if queries()[name](spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001  (report every query)
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(chosen) - len(failed)} of {len(chosen)} equal; failed: {failed}")
    spark.stop()


if __name__ == "__main__":
    main()
