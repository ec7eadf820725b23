"""Run queries and their oracles side by side: ``python -m tests.compare [sf] [name-part ...]``."""
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v: object) -> object:
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v.is_integer() else round(v, 9))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))


def differences(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str:
    """Empty when the query gives the oracle's rows, else a short account of what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return "" if got else "no rows"
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    want = rows_of(cols, res.fetchall())
    if got == want:
        return "" if got else "both empty"
    g, w = set(map(repr, got)), set(map(repr, want))
    only = [x[:700] for x in list(g - w)[:1]] + ["--"] + [x[:700] for x in list(w - g)[:1]]
    return f"rows {len(got)} / {len(want)}, only-here {len(g - w)}; " + "\n     ".join(only)


def session(cpus: str = "8"):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("compare")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main(argv: list[str]) -> int:
    import logging
    logging.disable(logging.CRITICAL)
    import __spark_entry__ as entry
    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    wanted = argv[1:]
    spark, con = session(), duck(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            msg = differences(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(msg)
        print(f"{'BAD ' if msg else 'ok  '} {name} {time.time() - t:.2f}s {msg}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
