"""Compare registered queries with their SQL: `python -m checks.verify [folder] [name ...]`."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.oracles import all_oracles  # noqa: E402
from checks.queries import all_queries  # noqa: E402


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", "/tmp/checkpoints")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name and rows in a fixed order; dates and NULLs in one form."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if column.dtype == object and column.map(lambda v: hasattr(v, "isoformat")).any():
            frame[name] = pd.to_datetime(column)
        elif str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[ns]")
    texts = frame.astype(object).where(frame.notna(), None).map(lambda v: "" if v is None else repr(v if not hasattr(v, "item") else v.item()))
    return texts.sort_values(list(texts.columns)).reset_index(drop=True)


def compare(found: pd.DataFrame, expected: pd.DataFrame) -> str:
    if sorted(found.columns) != sorted(expected.columns):
        return f"columns differ: {sorted(set(found.columns) ^ set(expected.columns))}"
    if len(found) != len(expected):
        return f"rows differ: {len(found)} against {len(expected)}"
    a, b = canonical(found), canonical(expected)
    for name in a.columns:
        if not a[name].equals(b[name]):
            bad = a[name] != b[name]
            return f"'{name}' differs in {int(bad.sum())} rows, e.g. {a[name][bad].iloc[0]} against {b[name][bad].iloc[0]}"
    return ""


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, failures = session(), 0
    database = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    oracles = all_oracles()
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = query(spark, folder).toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name}: {len(found)} rows, {took:.1f}s", flush=True)
                continue
            problem = compare(found, database.execute(oracles[name]).fetch_df())
        except Exception as error:  # noqa: BLE001 - report every query
            traceback.print_exc(limit=4) if names else None
            problem, took = f"{type(error).__name__}: {str(error).splitlines()[0][:300]}", time.time() - start
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok'}    {name}: {problem or f'{len(found)} rows'}, {took:.1f}s", flush=True)
    for name in set(oracles) - set(all_queries()):
        print("oracle without query:", name)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
