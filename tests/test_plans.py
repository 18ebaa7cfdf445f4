"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import os

import pytest
from conftest import SF_DIR

from cartwise import session
from cartwise.plans import registry


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rank_topk", "cand_user_history", "candidates_from_cooc"])
def test_best_n_per_group_is_cut_before_the_shuffle(spark, name):
    text = plan(registry.QUERIES[name](spark, SF_DIR))
    assert "WindowGroupLimit" in text
    assert "Partial" in text.split("WindowGroupLimit", 2)[2]


@pytest.mark.parametrize("name", ["time_window", "lookback_window", "x4_recency"])
def test_time_windows_reach_the_scan(spark, name):
    text = plan(registry.QUERIES[name](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "LessThan(o_orderdate" in text


def test_unused_columns_are_not_read(spark):
    text = plan(registry.QUERIES["x5_frequency"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


@pytest.mark.parametrize("name", ["top_items", "top_customers", "top_recommended"])
def test_reports_of_n_rows_do_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(registry.QUERIES[name](spark, SF_DIR))


def test_pairs_are_not_shuffled_while_features_are_made(spark):
    """The fan-out is the last thing that happens: no exchange above it."""
    text = plan(registry.QUERIES["feature_table"](spark, SF_DIR))
    before_fan_out = text.split("Generate posexplode", 1)[0]
    assert "Generate posexplode" in text
    assert "Exchange" not in before_fan_out


class _Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, folder=None, checkpoint=None):
        context = type("C", (), {"master": master, "applicationId": f"app-{master}", "getCheckpointDir": lambda _: checkpoint})
        self.sparkContext = context()
        self.conf = type("F", (), {"get": lambda _, key, default: folder})()


def test_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(_Session(master))
        assert session.shared_folder(_Session(master, "hdfs:///x/")) == f"hdfs:///x/cartwise-app-{master}"
        assert session.shared_folder(_Session(master, None, "s3a://y")) == f"s3a://y/cartwise-app-{master}"
    local = session.shared_folder(_Session("local[2]"))
    assert local == session.shared_folder(_Session("local[2]"))


def test_stored_tables_are_dropped(spark):
    stored = session.materialize(spark.range(3), "dropped")
    path = stored.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and session.shared_folder(spark) in path


def test_one_stored_table_is_discarded(spark):
    kept, gone = session.materialize(spark.range(3), "kept"), session.materialize(spark.range(3), "gone")
    path = gone.inputFiles()[0].removeprefix("file://")
    session.discard(gone)
    assert not os.path.exists(path) and kept.count() == 3
