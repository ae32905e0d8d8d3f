"""python tests/compare.py [SF] NAME...: a query beside its SQL, on whole tables. Without NAME: all with SQL."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return repr(round(v, 6)) if v == v else "nan"
        if isinstance(v, bool):
            return str(v).lower()
        if v.__class__.__name__ == "Decimal":
            return repr(round(float(v), 6))
        if isinstance(v, (list, tuple)):
            return str([cell(x) for x in v])
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p if p.is_file() else p / '*.parquet'}')")
    return con


def main(args):
    import __spark_entry__ as e
    from wayfold.session import build_session

    sf = args.pop(0) if args and (args[0].startswith("sf") or args[0].startswith("check")) else "sf0.01"
    d = f"/root/testdata/{sf}"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(d)
    sql, qs = e.oracle_sql(), e.queries()
    failed = []
    for name in args or list(qs):
        began = time.time()
        try:
            df = qs[name](spark, d)
            rows = df.collect()
        except Exception as x:
            print(f"{name:34} ERROR {str(x)[:1500]}", flush=True)
            failed.append(name)
            continue
        took = time.time() - began
        if name not in sql:
            print(f"{name:34} {len(rows):8} rows {took:6.1f}s (no SQL)", flush=True)
            continue
        began = time.time()
        try:
            cur = con.execute(sql[name])
            cols = [c[0] for c in cur.description]
            theirs = canonical(cur.fetchall(), cols)
        except Exception as x:
            print(f"{name:34} SQL ERROR {str(x)[:600]}", flush=True)
            failed.append(name)
            continue
        mine = canonical(rows, df.columns)
        same = mine == theirs and sorted(cols) == sorted(df.columns)
        print(f"{name:34} {'same' if same else 'DIFFERENT'} {len(mine):8} {len(theirs):8} rows {took:6.1f}s sql {time.time() - began:5.1f}s", flush=True)
        if not same:
            failed.append(name)
            a, b = set(mine), set(theirs)
            print("   columns", sorted(df.columns), sorted(cols), "\n   only here ", sorted(a - b)[:5], "\n   only there", sorted(b - a)[:5], flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
