"""Registered queries against the SQL that goes with them, on the smallest tables."""

import duckdb
import pytest

from shotlake.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("orders", "customer", "nation"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(str, frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_assembly_plans_every_granule_of_shots(spark):
    from shotlake.queries import shots

    made = {r.granule for r in QUERIES["product_assembly"](spark, SF).select("granule").distinct().collect()}
    assert made == {r.granule_key for r in shots(spark, SF).select("granule_key").distinct().collect()}
