"""Every registered flow query against its SQL in an independent engine."""

import os

import duckdb
import numpy as np
import pytest

from tidemark import flow_queries

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return c


def text(v):
    if v is None or v != v:
        return "~"
    if isinstance(v, (float, np.floating)):
        return f"{v:.6g}"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26]
    return str(v) if isinstance(v, str) else str(int(v))


def rows(pdf):
    names = sorted(pdf.columns)
    pdf = pdf[names].astype(object).where(pdf[names].notna(), None)
    return names, sorted("|".join(text(v) for v in r) for r in pdf.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(flow_queries.oracle_sql()))
def test_query(spark, con, sf_dir, name):
    got = flow_queries.queries()[name](spark, sf_dir).toPandas()
    want = con.sql(flow_queries.oracle_sql()[name]).df()
    assert rows(got) == rows(want)


def test_entry_without_the_optional_parts(spark, sf_dir):
    import __spark_entry__ as entry

    assert set(flow_queries.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["id", "observe", "proto", "hbos_score", "hbos_severity"]
