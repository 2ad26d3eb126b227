"""Run registered queries beside their SQL and compare every value."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Which types of the two engines count as the same.
SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(data_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{data_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result, none if equal."""
    names = sorted(df.columns)
    result = con.execute(sql)
    their_types = {c[0]: str(c[1]) for c in result.description}
    problems = []
    if sorted(their_types) != names:
        return [f"columns {names} against {sorted(their_types)}"]
    for name, kind in df.dtypes:
        if SAME_TYPES.get(kind) != their_types[name]:
            problems.append(f"type of {name}: {kind} against {their_types[name]}")
    order = [[c[0] for c in result.description].index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    ours = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
        return problems
    bad = [(a, b) for a, b in zip(ours, theirs) if not _equal(a, b)]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0][0]} against {bad[0][1]}")
    return problems


def _equal(a, b) -> bool:
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if x != y or math.copysign(1, x) != math.copysign(1, y):
                return False
        elif x != y:
            return False
    return True


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    data_dir = os.environ.get("RIDGELINE_TEST_DATA", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(data_dir)
    sql = entry.oracle_sql()
    wanted = sys.argv[1:]
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, data_dir)
            problems = compare(df, con, sql[name]) if name in sql else []
            note = "" if name in sql else f" (no SQL, {df.count()} rows)"
        except Exception as e:  # report and go on
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s{note}", *problems, sep="\n     ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
