import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def compare(spark, query, sql, folder):
    """Rows of a query and of its SQL as counters of rows with the columns in order of their names."""
    import datetime
    import decimal
    import glob
    from collections import Counter

    import duckdb

    def plain(v):
        if isinstance(v, (float, decimal.Decimal)):
            return round(float(v), 6)
        if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
            return datetime.datetime(v.year, v.month, v.day)
        return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = query(spark, folder)
    got = con.execute(sql)
    names = [x[0] for x in got.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    rows = got.fetchall()
    return Counter(tuple(plain(r[x]) for x in order) for r in df.collect()), Counter(tuple(plain(r[names.index(x)]) for x in order) for r in rows)
