"""Copies of rows counted out by many tasks; suffixes of repeated names without lists."""

from pyspark.sql import functions as F

from surveylake.operators.harmonise import unique_names
from surveylake.operators.ranking import numbered_copies
from surveylake.sources import silver


def test_copies_are_numbered_from_one(spark):
    rows = [("a", 1), ("b", 0), ("c", None), ("d", 7), ("e", 8), ("f", 30), ("g", -2)]
    df = spark.createDataFrame(rows, "key string, times bigint")
    got = sorted((r.key, r.nth) for r in numbered_copies(df, "times", "nth", ["key"], width=7).collect())
    assert got == sorted((key, nth) for key, times in rows for nth in range(1, (times or 0) + 1))
    assert numbered_copies(df.limit(0), "times", "nth", ["key"]).count() == 0


def test_ten_million_copies_come_out_of_many_tasks(spark):
    df = spark.range(1).select(F.lit("x").alias("key"), F.lit(10_000_000).cast("long").alias("times"))
    copies = numbered_copies(df, "times", "nth", ["key"])
    parts = copies.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("nth").alias("sum")).collect()
    assert sum(p.n for p in parts) == 10_000_000 and sum(p["sum"] for p in parts) == 10_000_000 * 10_000_001 // 2
    assert len(parts) == 8 and max(p.n for p in parts) < 2_500_000


def test_equal_respondents_without_id_are_all_kept(spark):
    """25,000 equal rows without id, one repeated id and one row of its own, over several partitionings."""
    canonical = spark.range(25_000).select(
        F.lit(None).cast("string").alias("respondente_id"), F.lit("x").alias("cargo"), F.lit(None).cast("string").alias("genero")
    )
    own = spark.createDataFrame([("r1", "b", None), ("r1", "a", "f"), (None, "z", None)], canonical.schema)
    ids = []
    for partitions in (1, 5):
        edition = silver.with_respondent_ids(canonical.unionByName(own).repartition(partitions), 2024).withColumn("survey_year", F.lit(2024))
        rows = silver.consolidate([edition]).collect()
        assert len(rows) == 25_002 and sorted((r.cargo, r.genero) for r in rows if r.respondente_id == "r1") == [("a", "f")]
        ids.append({r.respondente_id for r in rows})
        assert len(ids[-1]) == 25_002
    assert ids[0] == ids[1] and {i.rsplit("_", 1)[1] for i in ids[0] if i.endswith("_25000")} == {"25000"}


def test_suffixes_step_over_runs_of_names_already_taken(spark):
    names = ["x"] * 6 + ["x_2", "x_3", "x_5", "x_9", "x_9", "x_1", "x_0", "x_02"]
    df = spark.createDataFrame(list(enumerate(names)), "pos int, name string").withColumn("edition", F.lit("e"))
    got = [r.name for r in unique_names(df).orderBy("pos").collect()]
    assert got == ["x", "x_4", "x_6", "x_7", "x_8", "x_10", "x_2", "x_3", "x_5", "x_9", "x_9_2", "x_1", "x_0", "x_02"]
    text = unique_names(df)._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in text and "CartesianProduct" not in text
