"""Data tests measured while a table is written."""

import json
import os

import pytest
from pyspark.sql import functions as F

from snapmart.plans.quality import DataTest, measures, run_suite
from snapmart.sources import versions
from snapmart.sources.materialize import measured, read_table, write_table

SUITE = [
    DataTest("m", "id", "unique"),
    DataTest("m", "id", "not_null"),
    DataTest("m", "kind", "accepted_values", ("a", "b")),
    DataTest("m", "clean", "accepted_values", ("x",)),
    DataTest("n", "id", "not_null"),
]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("partitioned", [False, True])
def test_measured_results_equal_scanned_ones(spark, scratch, partitioned):
    df = spark.range(1000, numPartitions=7).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 400).alias("id"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "c").alias("kind"),
        F.lit("x").alias("clean"), (F.col("id") % 4).alias("part"))
    layout = {"partition_by": ["part"], "sort_within": ["part", "id"]} if partitioned else {}
    write_table(df, scratch, "m", measures=measures("m", SUITE), **layout)
    write_table(df.select("id"), scratch, "n", measures=measures("n", SUITE))
    tables = {"m": read_table(spark, scratch, "m"), "n": read_table(spark, scratch, "n")}
    known = measured(spark, scratch, "m") | measured(spark, scratch, "n")
    assert known == {"not_null_m_id": 100, "accepted_values_m_kind": 333, "accepted_values_m_clean": 0, "not_null_n_id": 100}
    short = run_suite(tables, SUITE, known)
    assert rows(short) == rows(run_suite(tables, SUITE))
    # One scan is left: of m, for the unique test and the values that are off the list.
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "clean" not in plan.split("Relation")[0].split("Aggregate")[-1]


def test_measures_belong_to_the_version(spark, scratch):
    df = spark.createDataFrame([(1, "a", "x"), (None, "c", "x")], "id int, kind string, clean string")
    write_table(df, scratch, "m", measures=measures("m", SUITE))
    assert measured(spark, scratch, "m")["not_null_m_id"] == 1
    broken = df.withColumn("id", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        write_table(broken, scratch, "m", measures=measures("m", SUITE))
    assert measured(spark, scratch, "m")["not_null_m_id"] == 1
    write_table(df.where("id = 1"), scratch, "m", measures=measures("m", SUITE))
    assert measured(spark, scratch, "m")["not_null_m_id"] == 0
    write_table(df, scratch, "m")
    assert measured(spark, scratch, "m") == {}
    with open(os.path.join(scratch, "m", versions.VERSIONS, f"{3:012d}.json")) as f:
        assert "measured" not in json.load(f)


def test_an_empty_table_is_measured(spark, scratch):
    df = spark.createDataFrame([], "id int, kind string, clean string")
    write_table(df, scratch, "m", measures=measures("m", SUITE))
    known = measured(spark, scratch, "m")
    assert set(known.values()) <= {0}
    assert all(r.failures == 0 for r in run_suite({"m": read_table(spark, scratch, "m")}, SUITE[:4], known).collect())
