"""Run registered queries against their SQL: python tests/oracle_check.py SF_DIR [NAME...]"""

from __future__ import annotations

import os
import sys
import traceback
from collections import Counter
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):  # noqa: ANN201
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def normal(rows, names):  # noqa: ANN001, ANN201
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda v: round(v, 6) if isinstance(v, float) else str(v) if v is not None and not isinstance(v, bool | int | str) else v
    return [names[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str:  # noqa: ANN001
    df = query(spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    rel = con.sql(sql)
    want = normal(rel.fetchall(), rel.columns)
    if got == want:
        return ""
    return f"{name}: {got[0]} {want[0]}; rows {sum(got[1].values())} {sum(want[1].values())}; only Spark {list((got[1] - want[1]).items())[:2]}; only SQL {list((want[1] - got[1]).items())[:2]}"


if __name__ == "__main__":
    root = str(Path(__file__).resolve().parents[1])
    sys.path.insert(0, root)
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[6]").config("spark.sql.shuffle.partitions", "6").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:]
    con, sql = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        if name not in sql:
            if names or not name.startswith(("op", "pipeline")):
                try:
                    print("NO SQL", name, query(spark, sf_dir).count())
                except Exception:  # noqa: BLE001
                    print("ERROR", name, traceback.format_exc()[-600:])
            continue
        try:
            bad = compare(spark, con, name, query, sql[name], sf_dir)
            print("BAD " + bad[:900] if bad else f"ok {name}")
        except Exception:  # noqa: BLE001
            text = traceback.format_exc()
            print("ERROR", name, text[-700:] if "JVM stacktrace" not in text else text[text.find("AnalysisException"):][:700])
