"""Compare a Spark result with DuckDB's: same columns, same types, same rows in any order."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


TIMES: list[float] = []


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    out = {}
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_float_dtype(column):
            # -0.0 and 0.0 stay apart on purpose: a value hash would tell them apart too
            out[name] = column.map(lambda v: "null" if pd.isna(v) else repr(float(v)))
        elif pd.api.types.is_datetime64_any_dtype(column):
            out[name] = column.astype("datetime64[us]").astype(str)
        else:
            out[name] = column.map(lambda v: "null" if v is None or v is pd.NA or v != v else str(v))
    result = pd.DataFrame(out)
    return result.sort_values(list(result.columns)).reset_index(drop=True)


def _nullable(kind):
    import pyarrow as pa

    return {
        pa.int32(): pd.Int32Dtype(),
        pa.int64(): pd.Int64Dtype(),
        pa.bool_(): pd.BooleanDtype(),
    }.get(kind)


def differences(df, sql: str, connection: duckdb.DuckDBPyConnection) -> list[str]:
    spark_table = df.toArrow()
    start = time.time()
    duck_table = connection.sql(sql).to_arrow_table()
    TIMES.append(time.time() - start)
    found = []
    left = {field.name: str(field.type) for field in spark_table.schema}
    right = {field.name: str(field.type) for field in duck_table.schema}
    if sorted(left) != sorted(right):
        return [f"columns {sorted(left)} / {sorted(right)}"]
    for name in left:
        same = {left[name].replace("large_", ""), right[name].replace("large_", "")}
        if len(same) > 1:
            found.append(f"type of {name}: {left[name]} / {right[name]}")
    a = canonical(spark_table.to_pandas(types_mapper=_nullable))
    b = canonical(duck_table.to_pandas(types_mapper=_nullable))
    if len(a) != len(b):
        return [*found, f"rows {len(a)} / {len(b)}"]
    if not a.equals(b):
        unequal = (a != b).any(axis=1)
        found.append(f"{int(unequal.sum())} rows differ, first\n{a[unequal].head(2)}\n{b[unequal].head(2)}")
    return found


def main(sf_dir: str, wanted: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = duck(sf_dir), 0
    queries, oracle = contract.queries(), contract.oracle_sql()
    for name, run in queries.items():
        if wanted and not any(name.startswith(prefix) for prefix in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                found = differences(df, oracle[name], connection)
                start += TIMES[-1]
                state = "ok" if not found else "DIFFERS " + "; ".join(found)
                bad += bool(found)
            else:
                state = f"rows only: {len(df.collect())}"
        except Exception as error:
            state, bad = "ERROR " + str(error)[:1500], bad + 1
        print(f"{name:40s} {time.time() - start:6.2f}s {state}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
