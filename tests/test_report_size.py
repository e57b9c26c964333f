"""The full report at size: what its plans leave to the driver."""

import os
import re
from collections import Counter

import pytest

from conftest import rows
from tallyline.operators import metrics, ordering
from tallyline.plans.catalogue import QUERIES
from tallyline.session import cut_lineage
from tallyline.sources import sinks
from tallyline.sources.bindings import DERIVED, Binding

DIRECTORY = "/root/testdata/sf0.001"
GROWING = re.compile("orderkey|custkey|partkey|suppkey|order_id|customer_id|product_id|store_id|store_key|k#")


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="test data absent")
def test_no_table_that_grows_is_broadcast(spark, monkeypatch):
    """Small tables, so that each passes the size check; stored frames are looked at as well."""
    plans = []

    def spied(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)

    monkeypatch.setattr(metrics, "cut_lineage", spied)
    monkeypatch.setattr(ordering, "cut_lineage", spied)
    blocks = metrics.compute_all(Binding(spark, DIRECTORY).tables())
    plans += [df._jdf.queryExecution().executedPlan().toString() for df in blocks.values()]
    keys = [k for text in plans for k in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", text)]
    assert any("nationkey" in k for k in keys) and not [k for k in keys if GROWING.search(k.replace("nationkey", "").replace("_bucket", ""))]


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="test data absent")
def test_landed_tables_keep_their_rows_and_need_no_join(spark, tmp_path):
    b = Binding(spark, DIRECTORY)
    lazy = b.tables()
    stored = sinks.landed(lazy, str(tmp_path), DERIVED)
    assert list(stored) == list(lazy) and stored.profile == lazy.profile
    for name in DERIVED:
        assert stored[name].schema.simpleString() == lazy[name].schema.simpleString()
        assert "Join" not in stored[name]._jdf.queryExecution().executedPlan().toString()
        assert rows(stored[name]) == rows(lazy[name])
    assert b.items_dated.columns == b.dated(b.items).columns
    assert rows(b.items_dated) == rows(b.dated(b.items))


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="test data absent")
def test_report_reads_lines_behind_joins_once(spark, monkeypatch):
    """The lines meet the parts once for the table of lines and once for the returns."""
    import tallyline.plans.extended as extended
    plans, write, compute = [], sinks.write_table, metrics.compute_all
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sinks, "write_table", lambda df, path, fmt="parquet": (plans.append(text(df)), write(df, path, fmt))[1])
    monkeypatch.setattr(extended.metrics, "compute_all", lambda t: (lambda blocks: (plans.extend(map(text, blocks.values())), blocks)[1])(compute(t)))
    got = {r.block: r.n_rows for r in QUERIES["all_blocks"](spark, DIRECTORY).collect()}
    joins = Counter(k for x in plans for k in re.findall(r"SortMergeJoin \[(l_partkey)", x))
    assert joins == {"l_partkey": 2} and got["quality_checks"] == 32
