import math

import duckdb
import pytest

from lumbre.plans import catalogue

DIR = "/root/testdata/sf0.001"


def rounded(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return (str(type(v)), str(v))
    try:
        return ("n", "nan" if math.isnan(float(v)) else f"{float(v):.9g}")
    except TypeError:
        return ("o", str(v))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_same_rows_as_sql(spark, name):
    df = catalogue.queries()[name](spark, DIR)
    rows = df.collect()
    if name not in catalogue.oracle_sql():
        return
    con = duckdb.connect()
    for t in ("customer", "documents", "events", "lineitem", "nation", "orders", "pages", "part", "region", "supplier"):
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    cur = con.execute(catalogue.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    wanted = sorted(tuple(rounded(r[names.index(c)]) for c in df.columns) for r in cur.fetchall())
    assert sorted(tuple(rounded(v) for v in r) for r in rows) == wanted
