"""Every query with SQL against DuckDB on the same tables; every other one runs."""

import decimal
import os

import duckdb
import pytest

import spanframe.plans.evidence_queries  # noqa: F401
import spanframe.plans.more_queries  # noqa: F401
import spanframe.plans.pack_queries  # noqa: F401
import spanframe.plans.row_queries  # noqa: F401
import spanframe.plans.span_queries  # noqa: F401
from spanframe.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        at = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{at + '/*.parquet' if os.path.isdir(at) else at}')")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else float(value) if isinstance(value, decimal.Decimal) else value


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


#: Those without SQL are held against plain versions in test_plain_versions.
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    found = duck.execute(queries.SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    rows = [[r[names.index(c)] for c in columns] for r in found.fetchall()]
    assert ordered(got) == ordered(rows)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
