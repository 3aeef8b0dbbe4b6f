"""The bucketed respondent table: plans without a shuffle of rows, replaced editions, statistics."""

import os
import re

import pytest
from pyspark.sql import functions as F

from surveylake.bindings.incremental import bucketed_lines, bucketed_people
from surveylake.operators import quality
from surveylake.operators.ranking import first_of_each
from surveylake.session import scratch_path, settings
from surveylake.sources import bucketed, gold

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_by(df):
    """The keys of every exchange of the plan, without the numbers of columns."""
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange (\S+\(.*?\))", plan(df))]


@pytest.fixture(scope="module")
def people(spark):
    return spark.table(bucketed_people(spark, SF_DIR))


def test_one_row_per_respondent_needs_no_shuffle(people):
    kept = first_of_each(people, ["survey_year", "respondente_id"], [F.col("idade"), F.col("valor")])
    assert shuffled_by(kept) == []
    assert kept.count() == people.count()


def test_repeated_ids_are_counted_where_they_lie(people):
    keys = shuffled_by(quality.edition_report(people, (1996, 1997)))
    assert keys and not any("respondente_id" in key for key in keys)


def test_two_tables_are_joined_where_they_lie(spark, people):
    lines = spark.table(bucketed_lines(spark, SF_DIR))
    keys = shuffled_by(quality.tables_overlap(people, lines))
    assert keys == ["hashpartitioning(survey_year, 8)"]


def test_a_block_overlap_shuffles_counts_per_edition_alone(people):
    overlap = quality.block_overlap(people, ["survey_year"], F.col("idade").isNotNull(), F.col("linguagens").isNotNull())
    assert shuffled_by(overlap) == ["hashpartitioning(survey_year, 8)"]


def test_an_edition_is_read_alone(people):
    text = plan(people.where("survey_year = 1997").groupBy("survey_year", "respondente_id").count())
    assert "PartitionFilters: [isnotnull(survey_year" in text and "Exchange" not in text


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "respondente_id string, idade int, itens array<string>, survey_year int")


@pytest.fixture
def place(spark):
    path = scratch_path(spark, "bucketed")
    database = "b_" + path.rsplit("-", 1)[-1]
    gold.create_database(spark, database, f"{path}-catalog")
    yield f"{database}.people", path
    spark.sql(f"DROP DATABASE {database} CASCADE")


COLUMNS = {"respondente_id": "string", "idade": "int", "itens": "array<string>"}


def _files(path):
    return {
        f"{os.path.basename(folder)}/{name}"
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def test_only_written_editions_are_replaced(spark, place):
    name, path = place
    bucketed.declare(spark, name, COLUMNS, path, 3)
    many = _rows(spark, *[(f"r{i}", i, ["a"], 2023 + i % 2) for i in range(200)])
    bucketed.write(many.repartition(7), name)
    before = _files(path)
    assert len(before) == 6  # one file for each bucket of an edition, whatever wrote it
    bucketed.write(_rows(spark, ("x", 1, None, 2024), ("y", None, [], 2025)), name)
    after = _files(path)
    assert {f for f in after if "=2023" in f} == {f for f in before if "=2023" in f}
    counts = {row[0]: row[1] for row in spark.table(name).groupBy("survey_year").count().collect()}
    assert counts == {2023: 100, 2024: 1, 2025: 1}


def test_a_session_in_static_mode_replaces_written_editions_only(spark, place):
    name, path = place
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        bucketed.declare(spark, name, COLUMNS, path, 3)
        bucketed.write(_rows(spark, ("a", 1, [], 2023), ("b", 2, [], 2024)), name)
        bucketed.write(_rows(spark, ("x", 1, None, 2024)), name)
        bucketed.declare(spark, name + "_again", COLUMNS, path, 3)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    assert {tuple(row) for row in spark.table(name + "_again").select("respondente_id", "survey_year").collect()} == {("a", 2023), ("x", 2024)}


def test_each_row_lies_in_the_bucket_of_its_id(spark, place):
    name, path = place
    bucketed.declare(spark, name, COLUMNS, path, 5)
    bucketed.write(_rows(spark, *[(f"r{i}", i, [], 2024) for i in range(100)]), name)
    found = spark.table(name).select(
        F.pmod(F.hash("respondente_id"), F.lit(5)).alias("bucket"), F.input_file_name().alias("file")
    )
    assert all(f"_{row['bucket']:05d}." in row["file"] for row in found.collect())


def test_the_number_of_buckets_belongs_to_the_files(spark, place):
    name, path = place
    bucketed.declare(spark, name, COLUMNS, path, 3)
    bucketed.write(_rows(spark, ("a", 1, [], 2024)), name)
    bucketed.declare(spark, name, COLUMNS, path, 3)
    with pytest.raises(ValueError, match="declared with 3 buckets"):
        bucketed.declare(spark, name, COLUMNS, path, 4)
    with pytest.raises(ValueError, match="written in"):
        bucketed.declare(spark, name + "_again", COLUMNS, path, 4)
    plain = f"{path}-plain"
    _rows(spark, ("a", 1, [], 2024)).write.partitionBy("survey_year").parquet(plain)
    with pytest.raises(ValueError, match="not written in buckets"):
        bucketed.declare(spark, name + "_plain", COLUMNS, plain, 3)
    with pytest.raises(ValueError, match="at least one"):
        bucketed.declare(spark, name + "_none", COLUMNS, path, 0)


def test_rows_without_id_are_an_error_and_none_are_none(spark, place):
    name, path = place
    bucketed.declare(spark, name, COLUMNS, path, 2)
    bucketed.write(_rows(spark), name)
    assert spark.table(name).count() == 0
    with pytest.raises(Exception, match="a respondent has no id"):
        bucketed.write(_rows(spark, (None, 1, [], 2024)), name)


def test_statistics_come_from_the_catalog(spark, place):
    name, path = place
    bucketed.declare(spark, name, COLUMNS, path, 2)
    bucketed.write(_rows(spark, ("a", 20, [], 2024), ("b", None, None, 2024), ("c", 30, [], 2025)), name)
    assert [tuple(row) for row in bucketed.edition_rows(spark, name).collect()] == [(2024, None), (2025, None)]
    bucketed.analyse(spark, name)
    assert [tuple(row) for row in bucketed.edition_rows(spark, name).collect()] == [(2024, 2), (2025, 1)]
    known = {row[0]: tuple(row)[1:] for row in bucketed.column_statistics(spark, name).collect()}
    assert known == {"respondente_id": (0, None, None), "idade": (1, "20", "30"), "survey_year": (0, "2024", "2025")}


def test_tables_overlap_counts_people_once(spark):
    one = _rows(spark, ("a", 1, [], 2024), ("a", 2, [], 2024), ("b", 1, [], 2024), (None, 1, [], 2024), ("c", 1, [], 2025))
    two = _rows(spark, ("a", 1, [], 2024), ("c", 1, [], 2024), ("d", 1, [], None))
    found = {tuple(row) for row in quality.tables_overlap(one, two).collect()}
    assert found == {(2024, 2, 2, 1), (2025, 1, 0, 0)}
