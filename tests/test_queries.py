import glob
import os

import duckdb
import pytest

from tallyforge import plans

SF = "/root/testdata/sf0.001"


def rows(found, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in found)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_same_rows_as_sql(spark, name):
    df = plans.QUERIES[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    if name in plans.ORACLE_SQL:
        con = duckdb.connect()
        for path in glob.glob(f"{SF}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        cursor = con.execute(plans.ORACLE_SQL[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert rows(found, df.columns) == rows(cursor.fetchall(), names)
