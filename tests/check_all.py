"""Run every registered query against its SQL twin: ``python tests/check_all.py [sf dir] [names]``."""

import datetime
import decimal
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def compare(df, con, sql):
    """None if both sides agree, else a short report."""
    mine_cols, mine = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    cols = [d[0] for d in cursor.description]
    their_cols, theirs = normal(cols, cursor.fetchall())
    if mine_cols != their_cols:
        return f"columns {mine_cols} != {their_cols}"
    if mine == theirs:
        return None
    left = sorted(set(map(repr, mine)) - set(map(repr, theirs)))[:3]
    right = sorted(set(map(repr, theirs)) - set(map(repr, mine)))[:3]
    return f"rows {len(mine)} / {len(theirs)}\n   spark {left}\n   sql   {right}"


def main():
    from orderloom.session import local_session
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = []
    print("without SQL:", sorted(set(queries) - set(oracle)), "without query:", sorted(set(oracle) - set(queries)))
    for name in names:
        began = time.time()
        try:
            report = compare(queries[name](spark, folder), con, oracle[name])
        except Exception:
            report = "\n".join(traceback.format_exc().strip().splitlines()[-1:])[:700]
        if report:
            bad.append(name)
        print(f"{'FAIL' if report else 'ok  '} {name} {time.time() - began:.1f}s {report or ''}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} agree; bad: {bad}")


if __name__ == "__main__":
    main()
