"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    conn = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        conn.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return conn


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, independent of row order and NULL spelling."""
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if pd.isna(v) else float(v) if isinstance(v, float) else str(v) for v in row)
        for row in frame.astype(object).itertuples(index=False)
    ]
    return sorted(rows, key=repr)


def compare(spark, conn, build, sql: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    mine = build(spark, folder)
    theirs = conn.execute(sql)
    types = {d[0]: str(d[1]) for d in theirs.description}
    theirs = theirs.fetchdf()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
        "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
    }
    for name, kind in mine.dtypes:
        if names[kind] != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    # Rows via Arrow so that integers next to NULLs stay integers.
    a = canonical(mine.toArrow().to_pandas(types_mapper=pd.ArrowDtype))
    b = canonical(conn.sql(sql).to_arrow_table().to_pandas(types_mapper=pd.ArrowDtype))
    if a == b:
        return None
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return (
        f"{len(a)} rows != {len(b)} rows; only here {sorted(only_a, key=repr)[:3]}, "
        f"only in SQL {sorted(only_b, key=repr)[:3]}"
    )


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from paperloom.session import build_session

    spark = build_session(
        "oracle",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
         "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    conn, failed = connect(folder), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in oracle_sql():
                problem = compare(spark, conn, build, oracle_sql()[name], folder)
            else:
                problem = None
                print(build(spark, folder).toPandas().to_string())
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
