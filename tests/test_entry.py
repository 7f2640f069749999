"""The driver's contract: every query runs on the smallest tables, SQL agrees, the llm subpackage may be missing."""

import importlib
import math
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from reconlake.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings price_stage treatment_plan nonqueue_facility locator locator_match product_registry eval_item mix_target doc_label".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        p = f"/root/testdata/sf0.001/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v).replace("+00:00", "") if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql_gives_the_same_rows(spark, duck, data, name):
    df = catalog.queries()[name](spark, data)
    cols = sorted(df.columns)
    r = duck.sql(catalog.oracle_sql()[name])
    at = [list(r.columns).index(c) for c in cols]
    want = sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=str)
    assert sorted((tuple(plain(x[c]) for c in cols) for x in df.collect()), key=str) == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_other_queries_run(spark, data, name):
    df = catalog.queries()[name](spark, data)
    rows = df.collect()
    assert rows and len(df.columns) == len(set(df.columns))
    assert sorted(map(str, rows)) == sorted(map(str, catalog.queries()[name](spark, data).collect()))  # the same on every run


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_llm_is_optional(monkeypatch):
    for m in [m for m in sys.modules if m.startswith("reconlake.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "reconlake.llm", None)
    assert set(entry.queries()) == set(catalog.queries())
    importlib.invalidate_caches()


def test_nothing_else_imports_llm():
    root = os.path.join(os.path.dirname(entry.__file__), "reconlake")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as h:
                    assert "reconlake.llm" not in h.read(), f
