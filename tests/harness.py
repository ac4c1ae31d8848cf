"""Local copy of the driver's correctness gate: run a catalogue query in Spark and its
oracle SQL in DuckDB on the same parquet tables; compare row count, column names,
column kinds and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb
import pandas as pd

SF001 = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str = SF001) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, str)):
        return str([_norm(x) for x in (v.tolist() if hasattr(v, "tolist") else v)])
    return str(v)


def _kind(series: pd.Series) -> str:
    k = series.dtype.kind
    if k in "iu":
        return "int"
    if k == "f":
        nonnull = series.dropna()
        if len(nonnull) and (nonnull == nonnull.round()).all() and series.isna().any():
            return "int_or_float"
        return "float"
    if k == "b":
        return "bool"
    return "other"


def frame_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted("|".join(str(_norm(r[c])) for c in cols) for _, r in df[cols].iterrows())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, name: str, fn, sql: str, sf_dir: str = SF001) -> dict:
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    dk = duck(sf_dir).execute(sql).df()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(sp), "oracle_rows": len(dk),
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    res["cols_match"] = sorted(sp.columns) == sorted(dk.columns)
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(sp.columns), sorted(dk.columns)
        res["ok"] = False
        return res
    kinds = {c: (_kind(sp[c]), _kind(dk[c])) for c in sp.columns}
    res["kind_mismatch"] = {c: k for c, k in kinds.items()
                            if k[0] != k[1] and "int_or_float" not in k}
    res["hash_match"] = frame_hash(sp) == frame_hash(dk)
    res["ok"] = res["spark_rows"] == res["oracle_rows"] and res["hash_match"] and not res["kind_mismatch"]
    if not res["hash_match"]:
        cols = sorted(sp.columns)
        a = set("|".join(str(_norm(r[c])) for c in cols) for _, r in sp[cols].iterrows())
        b = set("|".join(str(_norm(r[c])) for c in cols) for _, r in dk[cols].iterrows())
        res["only_spark"] = sorted(a - b)[:3]
        res["only_oracle"] = sorted(b - a)[:3]
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from screenlake.session import get_spark

    spark = get_spark(shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    names = argv or sorted(orc)
    bad = 0
    for n in names:
        if n not in orc:
            df = qs[n](spark, SF001)
            print(f"ROWS-ONLY {n}: {df.count()} rows, cols={df.columns}", flush=True)
            continue
        try:
            r = compare(spark, n, qs[n], orc[n])
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "error": repr(e)[:800]}
        bad += not r["ok"]
        print(("PASS " if r["ok"] else "FAIL ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
