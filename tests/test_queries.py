"""Every query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import datetime
import math

import duckdb
import pytest

from inkwell.plans import catalog, registry

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"model_selection", "tree_selection", "outlier_removal"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SLOW))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if sql := registry.oracle_sql().get(name):
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_every_query_names_what_it_covers():
    assert all(catalog.COVERS[name] for name in registry.queries())


def test_rules_and_dates(spark):
    from pyspark.sql import functions as F

    from inkwell.functions import dates, text

    cases = {
        "2019-03-15": "2019-03-15", "2019-03-15T10:30:00": "2019-03-15", "2019-03": "2019-03-01", "2019": "2019-01-01", "Mar 2019": "2019-03-01", "2019 Mar": "2019-03-01",
        "March 2019": "2019-03-01", "2019 Mar-Apr": "2019-03-01", "Summer 2019": "2019-01-01", "": None, "  ": None, "no date here": None, "Mar": None, None: None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "raw string").select("raw", dates.reference_date(F.col("raw")).alias("d")).collect()
    assert {r["raw"]: r["d"] and str(r["d"]) for r in rows} == cases
    tokens = spark.createDataFrame([("ttTi4348, mgDf50 and e1370; not B2, words or 12.",)], "t string").select(text.allele_tokens(F.col("t")).alias("a")).first()["a"]
    assert sorted(tokens) == ["e1370", "mgDf50", "ttTi4348"]


def test_longest_match_is_leftmost_and_bounded():
    from inkwell.operators.dictionary import NameIndex

    found = list(NameIndex.of(["unc", "unc-119", "ed3", "(x)"]).find("unc-119(ed3) uncle unc (x)"))
    assert [m[0] for m in found] == ["unc-119", "ed3", "unc", "(x)"]
