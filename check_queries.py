"""Run registered queries next to their SQL and compare values. Usage: check_queries.py [dir] [name ...]"""

import sys
import time

import duckdb
import pandas as pd

from strataloom.queries import ORACLES, QUERIES
from strataloom.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or v != v
                          else repr(float(v) + 0.0) if isinstance(v, float) else str(v)[:10]
                          if hasattr(v, "isoformat") else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = normal(got), normal(want)
    for c in a.columns:
        bad = (a[c].fillna("<null>") != b[c].fillna("<null>"))
        if bad.any():
            i = bad.idxmax()
            return f"{c}: {int(bad.sum())} differ\n   {dict(a.loc[i])}\n   {dict(b.loc[i])}"
    return "ok" if len(got) else "EMPTY"


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    failed = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns)
            took = time.time() - start
            if name not in ORACLES:
                verdict = "rows only" if len(got) else "EMPTY"
            else:
                rel = con.execute(ORACLES[name])
                cols = [d[0] for d in rel.description]
                want = pd.DataFrame(rel.fetchall(), columns=cols)
                verdict = compare(got.astype(object), want.astype(object))
                kinds = {c: str(t) for c, t in zip(cols, con.sql(ORACLES[name]).types)}
                pairs = {c: (f.simpleString(), kinds.get(c)) for c, f in ((x.name, x.dataType) for x in df.schema)}
                same = {("bigint", "BIGINT"), ("int", "INTEGER"), ("string", "VARCHAR"), ("double", "DOUBLE"),
                        ("date", "DATE"), ("boolean", "BOOLEAN")}
                odd = {c: p for c, p in pairs.items() if p not in same}
                if odd:
                    verdict += f" TYPES {odd}"
        except Exception as e:  # noqa: BLE001
            took, verdict = time.time() - start, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        failed += verdict not in ("ok", "rows only")
        print(f"{name:28s} {took:6.2f}s rows={len(got) if 'got' in dir() else '-'} {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
