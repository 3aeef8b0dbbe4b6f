"""What the physical plans must and must not contain."""

import pytest

from surveylake.bindings.editions import export_raw
from surveylake.plans.marts import MARTS, build_mart
from surveylake.session import scratch_path
from surveylake.sources import bronze, silver

from surveylake.bindings import all_registries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for part in all_registries() for name, query in part.queries.items()}


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval"):
        assert operator not in text


def test_unused_line_answers_drop_out(spark):
    text = plan(spark, "G1")
    assert "lineitem" not in text and "part.parquet" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "F4")
    assert "l_extendedprice" not in text and "p_partkey" not in text


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "O4")
    assert "WindowGroupLimit" in plan(spark, "H16")


def test_adoption_scans_once(spark):
    text = plan(spark, "G4")
    assert text.count("orders.parquet") == 1


BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval")


@pytest.mark.parametrize("name", ["Q2.1", "P3", "P11"])
def test_one_cut_does_not_read_the_others(spark, name):
    assert "lineitem" not in plan(spark, name)


def test_written_tables_have_sound_plans(spark):
    """The plans that write Bronze, Silver and Gold, each before it is written."""
    raw = export_raw(spark, SF_DIR)
    frames = bronze.bronze_frames(spark, bronze.list_csv_files(spark, raw))
    home = scratch_path(spark, "plans")
    bronze.ingest(spark, raw, f"{home}/bronze")
    people = silver.conform(spark, f"{home}/bronze")
    written = [*frames.values(), people, *[build_mart(name, people) for name in MARTS]]
    texts = [df._jdf.queryExecution().executedPlan().toString() for df in written]
    for text in texts:
        assert not any(operator in text for operator in BAD)
    conformed = texts[len(frames)]
    assert conformed.count("FileScan parquet") == len(frames)  # each edition is read once
    assert "Window" not in conformed


@pytest.mark.parametrize("name", ["K1", "P1", "P6", "P10"])
def test_figures_of_the_latest_edition_start_no_job(spark, name, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def no_job(*_):
        raise AssertionError("a job ran while the plan was built")

    for action in ("collect", "first", "head", "take", "count", "isEmpty", "toPandas"):
        monkeypatch.setattr(DataFrame, action, no_job)
    assert "Subquery" in plan(spark, name)
