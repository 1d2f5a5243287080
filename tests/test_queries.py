"""Every query with a SQL twin gives the same rows as the twin."""

import glob
import math

import duckdb
import pytest
from core_data import DATA

from gneiss import queries as batch
from gneiss.sources import queries as source
from gneiss.streaming import queries as stream

ALL, SQL = batch.QUERIES | source.QUERIES | stream.QUERIES, batch.ORACLE_SQL | source.ORACLE_SQL | stream.ORACLE_SQL


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {p.split('/')[-1][:-8]} as select * from read_parquet('{p}')")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v if isinstance(v, (bool, int, float)) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, db, name):
    df = ALL[name](spark, DATA)
    columns = sorted(df.columns)
    found = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    twin = db.execute(SQL[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert found == sorted((tuple(plain(r[i]) for i in at) for r in twin.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_alarm_hysteresis_against_a_loop(spark):
    found = sorted((r["user_id"], r["seq"], r["alarm_type"], r["state"]) for r in ALL["alarm_hysteresis"](spark, DATA).collect())
    active, expected = {}, []
    for r in spark.read.parquet(f"{DATA}/events.parquet").orderBy("ts", "event_id").collect():
        level = "HIHI" if r["value"] >= 250 else "HI" if r["value"] >= 100 else None
        now = active.get(r["user_id"])
        if level and level != now and (now is None or level == "HIHI"):
            active[r["user_id"]] = level
            expected.append((r["user_id"], r["event_id"], level, "ACTIVE"))
        elif now and r["value"] < 85:
            del active[r["user_id"]]
            expected.append((r["user_id"], r["event_id"], now, "CLEARED"))
    assert found == sorted(expected)
