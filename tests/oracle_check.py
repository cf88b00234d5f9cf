"""Compare every query with its SQL on one data folder: python tests/oracle_check.py [folder] [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def compare(spark, con, query, sql: str, folder: str) -> str | None:
    """None when columns and the multiset of rows agree, else what differs."""
    df = query(spark, folder)
    got_names = sorted(df.columns)
    got = sorted(tuple(map(_plain, r)) for r in df.select(*[f"`{c}`" for c in got_names]).collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != got_names:
        return f"columns {got_names} != {sorted(names)}"
    index = [names.index(n) for n in got_names]
    want = sorted(tuple(_plain(r[i]) for i in index) for r in cursor.fetchall())
    if got == want:
        return None
    extra = list(set(got) - set(want))[:3]
    missing = list(set(want) - set(got))[:3]
    return f"rows {len(got)} != {len(want)}; only here {extra}; only in SQL {missing}"


def main() -> int:
    import __spark_entry__ as entry
    from wrenchline.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        sql = entry.oracle_sql().get(name)
        start = time.time()
        try:
            problem = compare(spark, con, query, sql, folder) if sql else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print("different:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
