"""Listings without columns of parts: lines keep their number, and only their keys meet the parts."""

import datetime as dt

import pytest

from lodgecurve.checks import listings as made
from lodgecurve.checks import queries as q


@pytest.fixture
def tables(spark, tmp_path):
    def write(part_keys, line_keys):
        day = dt.datetime(1997, 7, 4)
        rows = {
            "nation": ([(1, "Peru")], "n_nationkey int, n_name string"),
            "customer": ([(7, 1)], "c_custkey long, c_nationkey int"),
            "orders": ([(100, 7, "O", day), (200, 7, "P", day), (200, 7, "P", day), (None, 7, "P", day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz"),
            "part": ([(k, f"TYPE {k}", 4) for k in part_keys], "p_partkey long, p_type string, p_size int"),
            "lineitem": (
                [(o, k, n, float(n), 1000.0 * n, 0.0, 0.0, "R", "O") for n, k in enumerate(line_keys) for o in (100, 200, None)],
                "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
            ),
        }
        for name, (data, schema) in rows.items():
            spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.mark.parametrize("part_keys", [[1, 2, 3], [1, 2, 2, 2, None, 9], [], [None]])
@pytest.mark.parametrize("line_keys", [[1, 2, 3, 3], [1, 2, None, 4, 2]])
def test_lines_are_as_many_as_joined(spark, tables, monkeypatch, part_keys, line_keys):
    monkeypatch.setattr(made, "_sent_to_all", lambda df: False)
    place = tables(part_keys, line_keys)
    rows = lambda df: sorted(map(str, df.select(q.SOLD).collect()))
    assert rows(made.listings(spark, place, *q.SOLD)) == rows(made.listings(spark, place))


def test_lines_are_not_shuffled_by_part(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(made, "_sent_to_all", lambda df: False)
    plan = lambda *columns: made.listings(spark, sf_dir, *columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan(*q.SOLD)
    assert "p_partkey" in plan() and "p_partkey" in plan(*q.PROFILED)
    assert made.listings(spark, sf_dir, *q.SOLD).columns == [c for c in made.LISTING_COLS if c not in made.OF_PARTS]
    assert made.listings(spark, sf_dir).columns == made.LISTING_COLS
