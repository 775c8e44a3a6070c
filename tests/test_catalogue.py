"""Every query of the catalogue against its SQL in DuckDB, and the plans of those that must not pair everything."""

import math

import duckdb
import pytest

from atelier.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return ""
    return repr(round(float(x), 5) + 0.0) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["nearest_label", "nearest_strict_radius", "first_within_radius", "closest_pair", "text_containment_join", "inverted_index", "page_keyword_scores"])
def test_plans_stay_linear_and_native(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("NestedLoop", "Cartesian", "Python", "Arrow"))


def test_entry_module_stands_without_the_pipeline_subpackage(spark, monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    for k in [k for k in sys.modules if k.startswith("atelier.llm") or k == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, k)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("atelier.llm") or name == "corpus_pipeline":
                raise ModuleNotFoundError(name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    importlib.invalidate_caches()
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(SQL)
