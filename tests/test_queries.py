"""Every registered query of the library's own operators against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from groundshift.queries import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def ordered(rows, columns):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([r[i] for i in at] for r in rows), key=lambda r: [(x is None, round(x, 3) if isinstance(x, float) else 0, str(x)) for x in r])


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and math.isclose(float(a), float(b), rel_tol=1e-6, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    got = ordered([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(oracle_sql()[name])
    want = ordered(cursor.fetchall(), [d[0] for d in cursor.description])
    assert sorted(df.columns) == sorted(d[0] for d in cursor.description)
    assert len(got) == len(want)
    assert all(same(x, y) for g, w in zip(got, want, strict=True) for x, y in zip(g, w, strict=True))


def test_entry_ranks_parcels(spark, sf_dir):
    assert entry(spark, sf_dir).count() > 0
