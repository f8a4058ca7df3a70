"""Registered queries against their SQL oracles on the smallest tables."""

import math

import duckdb
import pytest

from lodgecurve.checks import registry

TABLES = "customer lineitem nation orders part region supplier".split()
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
SAMPLE = """
bool_flags tolerant_casts segment_key_roundtrip listing_features segment_dataset outlier_filter competition_features
days_per_segment price_bins breakpoint_search regime_lookup three_way_split optimal_prices solution_status lift_report portfolio_kpis weekend_premium price_schedule linear_fit ingest_csv
elasticity_json preview
""".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def order(row):
    """Sort key that leaves out what rounding may change."""
    return [("", "nan" if math.isnan(v) else f"{v:.3e}") if isinstance(v, float) else (repr(v), "") for v in row]


def same(a, b):
    """Equal, or doubles no further apart than the last rounded digit."""
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12, abs_tol=2e-5)
    return a == b


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, db, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = db.sql(registry.ORACLE[name])
    assert sorted(want.columns) == columns
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    at = [want.columns.index(c) for c in columns]
    texts = [c for c in columns if types[c] != "DOUBLE"]
    exact_first = [columns.index(c) for c in texts] + [columns.index(c) for c in columns if c not in texts]
    expected = sorted((tuple(row[i] for i in at) for row in want.fetchall()), key=lambda r: order([r[i] for i in exact_first]))
    found = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=lambda r: order([r[i] for i in exact_first]))
    assert len(found) == len(expected)
    wrong = [(f, e) for f, e in zip(found, expected) if not all(map(same, f, e))]
    assert not wrong, wrong[:3]


def test_every_oracle_has_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)
