"""Run registered queries against their oracle: same columns, same rows, same values.

    python tests/compare.py [sf0.01] [name prefix ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """Why the two results differ; empty when they do not. Values are compared exactly, with types."""
    names = sorted(df.columns)
    mine = Counter(tuple((type(r[n]).__name__, r[n]) for n in names) for r in df.collect())
    res = con.execute(sql)
    columns = [x[0] for x in res.description]
    if sorted(columns) != names:
        return [f"columns {names} / {sorted(columns)}"]
    order = [columns.index(n) for n in names]
    theirs = Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in res.fetchall())
    if mine == theirs:
        return []
    return [f"rows {sum(mine.values())} / {sum(theirs.values())}", f"only here: {list((mine - theirs).items())[:2]}",
            f"only oracle: {list((theirs - mine).items())[:2]}"]


def main(sf: str = "sf0.01", *prefixes: str) -> int:
    import __spark_entry__ as e
    from claimwright.session import get_spark

    spark = get_spark(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(f"{TESTDATA}/{sf}"), 0
    oracles = e.oracle_sql()
    for name, fn in e.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, f"{TESTDATA}/{sf}")
            found = differences(df, con, oracles[name]) if name in oracles else [] if df.count() >= 0 else []
        except Exception as ex:  # noqa: BLE001
            found = [f"{type(ex).__name__}: {str(ex)[:600]}"]
        bad += bool(found)
        kind = "ok" if name in oracles else "no oracle"
        print(f"{'DIFF' if found else kind:9} {name:34} {time.time() - start:6.2f}s", *found, sep="\n      " if found else " ", flush=True)
    print("queries with differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
