"""Compare every query with its SQL on one scale factor: python tests/check_oracle.py [sf] [names…]

CHECK_CONF holds extra session settings, e.g. spark.sql.autoBroadcastJoinThreshold=-1 to
check the plans that large tables get.
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return f"{v:f}"
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, cur.fetchall())
    if got == want:
        return None
    g, w = set(got), set(want)
    return f"rows {len(got)} vs {len(want)}; only here {sorted(g - w)[:3]}; only sql {sorted(w - g)[:3]}"


def main() -> int:
    import __spark_entry__ as entry
    from feira.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    extra = dict(kv.split("=", 1) for kv in os.environ.get("CHECK_CONF", "").split(",") if kv)
    spark = local_session(
        8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", **extra}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        sql, t = entry.oracle_sql().get(name), time.time()
        try:
            problem = compare(spark, con, name, query, sql, sf_dir) if sql else "no sql"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
