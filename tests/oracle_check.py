"""Compare registered queries with their DuckDB statements: python tests/oracle_check.py [sf_dir] [names...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(v) for v in row) for row in df.select(*names).collect())


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = cursor.fetchall()
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else a short account of the difference."""
    names, ours = spark_rows(df)
    other_names, theirs = duck_rows(con, sql)
    if names != other_names:
        return f"columns differ: {sorted(set(names) ^ set(other_names))}"
    if ours != theirs:
        left, right = ours - theirs, theirs - ours
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; columns {names}; "
            f"only ours {list(left)[:2]}; only theirs {list(right)[:2]}"
        )
    return None


def main() -> int:
    from remitmatch.session import build_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, build in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                rows = ""
                if problem is None:
                    rows = "equal"
            else:
                problem, rows = None, f"{df.count()} rows (no oracle)"
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or rows}", flush=True)
    print("failed:", failed, "of", len(queries), "missing oracle:", sorted(set(queries) - set(oracle)),
          "stray oracle:", sorted(set(oracle) - set(queries)))
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
