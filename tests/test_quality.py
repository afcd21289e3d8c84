from conftest import plan
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.operators.quality import Checks


def sample(spark):
    return spark.createDataFrame(
        [("a", "x", 1), ("a", "y", None), (None, "z", 2), (None, None, None), ("b", "z", 3)],
        "id string, kind string, n int",
    )


CHECKS = Checks(unique=["id", "kind"], not_null=["id", "n"], accepted={"kind": ["x", "y"]})


def test_failing_rows(spark):
    df = sample(spark)
    assert [tuple(r) for r in quality.duplicates(df, "id").collect()] == [("a", 2)]
    assert quality.null_rows(df, "n").count() == 2
    assert [tuple(r) for r in quality.unaccepted(df, "kind", ["x", "y"]).collect()] == [("z", 2)]


def test_report_counts_each_check(spark):
    got = {(r.column_name, r.test): r.failures for r in quality.check_relation(sample(spark), "t", CHECKS).collect()}
    assert got == {
        ("id", "unique"): 1, ("kind", "unique"): 1, ("id", "not_null"): 2, ("n", "not_null"): 2,
        ("kind", "accepted_values"): 1,
    }


def test_report_lists_passing_checks_of_an_empty_relation(spark):
    empty = sample(spark).filter("false")
    assert {r.failures for r in quality.check_relation(empty, "t", CHECKS).collect()} == {0}
    assert quality.check_relation(empty, "t", CHECKS).count() == 5


def test_one_scan_per_relation(spark, tmp_path):
    sample(spark).write.parquet(str(tmp_path / "t"))
    report = quality.check_relation(spark.read.parquet(str(tmp_path / "t")), "t", CHECKS)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_null_counts(spark):
    got = {r.column_name: r.failures for r in quality.null_counts(sample(spark), ["id", "kind", "n"]).collect()}
    assert got == {"id": 2, "kind": 1, "n": 2}


def test_hot_value_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert [tuple(r) for r in quality.duplicates(hot, "k").collect()] == [("hot", 1000)]
    assert "partial_count" in plan(quality.duplicates(hot, "k"))


def test_suite_declares_24_checks():
    every = [c for relations in quality.SUITE.values() for c in relations.values()]
    assert sum(len(c.unique) for c in every) == 3
    assert sum(len(c.not_null) for c in every) == 16
    assert sum(len(c.accepted) for c in every) == 5
