"""NOT IN, null-safe anti join and upsert against brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from layerwright.operators import joins

PAIRS = st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, 1, 2])), max_size=6)
RELAXED = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def pairs(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "a int, b int, n int")


@RELAXED
@given(PAIRS, PAIRS)
def test_not_in_follows_sql(spark, outer, inner):
    def kept(row):
        return not any(all(x is None or y is None or x == y for x, y in zip(row, other)) for other in inner)

    result = joins.not_in(pairs(spark, outer), pairs(spark, inner), ("a", "b"))
    assert sorted(r.n for r in result.collect()) == [i for i, row in enumerate(outer) if kept(row)]


@pytest.mark.parametrize("inner", [[], [(1, 2)], [(1, None)], [(None, None)]])
def test_not_in_agrees_with_spark_sql(spark, inner):
    outer = [(1, 2), (1, None), (None, 2), (2, 2), (None, None)]
    pairs(spark, outer).createOrReplaceTempView("o")
    pairs(spark, inner).createOrReplaceTempView("i")
    expected = spark.sql("SELECT n FROM o WHERE (a, b) NOT IN (SELECT a, b FROM i)")
    result = joins.not_in(spark.table("o"), spark.table("i"), ("a", "b"))
    assert sorted(r.n for r in result.collect()) == sorted(r.n for r in expected.collect())


def test_not_in_needs_no_null_cases_for_required_columns(spark):
    outer = spark.range(5).withColumnRenamed("id", "a")
    plan = joins.not_in(outer, outer.where("a > 2"), ("a",))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert joins.not_in(outer, outer.where("a > 2"), ("a",)).count() == 3


def test_only_the_null_flags_are_looped_over(spark):
    outer = spark.range(5).selectExpr("IF(id = 0, NULL, id) AS a", "IF(id = 1, NULL, id) AS b", "id AS n")
    plan = joins.not_in(outer, outer.where("n > 2"), ("a", "b"))._jdf.queryExecution().optimizedPlan().toString()
    without_equality = [line for line in plan.splitlines() if "Join LeftAnti" in line and "= _v_" not in line]
    assert len(without_equality) == 1
    assert "CartesianProduct" not in plan


def test_not_in_reads_each_side_once(spark, tmp_path):
    for side in ("o", "i"):
        spark.range(50).selectExpr("IF(id % 9 = 0, NULL, id % 20) AS a", "IF(id % 7 = 0, NULL, id % 11) AS b", f"id AS {side}").write.parquet(
            str(tmp_path / side))
    outer, inner = (spark.read.parquet(str(tmp_path / side)) for side in ("o", "i"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (threshold, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            result = joins.not_in(outer, inner.where("i % 13 = 1"), ("a", "b"))
            result.collect()
            final = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert final.count("FileScan") == 2


@RELAXED
@given(PAIRS, PAIRS)
def test_null_safe_anti_join(spark, outer, inner):
    result = joins.anti_join_nullsafe(pairs(spark, outer), pairs(spark, inner), ("a", "b"))
    assert sorted(r.n for r in result.collect()) == [i for i, row in enumerate(outer) if row not in inner]


@RELAXED
@given(st.dictionaries(st.integers(1, 5), st.integers(0, 3)), st.dictionaries(st.integers(1, 5), st.integers(0, 3)))
def test_upsert_replaces_adds_and_is_idempotent(spark, target, source):
    t = spark.createDataFrame(list(target.items()), "k int, v int")
    s = spark.createDataFrame(list(source.items()), "k int, v int")
    once = joins.upsert(t, s, ("k",))
    assert {r.k: r.v for r in once.collect()} == {**target, **source}
    twice = joins.upsert(once, s, ("k",))
    assert sorted(twice.collect()) == sorted(once.collect())


def test_upsert_adds_new_columns(spark):
    t = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    s = spark.createDataFrame([(2, 5, "x")], "k int, v int, w string")
    assert sorted(map(tuple, joins.upsert(t, s, ("k",)).collect())) == [(1, 1, None), (2, 5, "x")]


def test_upsert_refuses_ambiguous_sources(spark):
    t = spark.createDataFrame([(1, 1)], "k int, v int")
    s = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    with pytest.raises(PySparkException, match="several source rows share one key"):
        joins.upsert(t, s, ("k",)).collect()


def test_upsert_keeps_repeated_target_rows_of_other_keys(spark):
    t = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (2, 3), (None, 4), (None, 4)], "k int, v int")
    s = spark.createDataFrame([(2, 5)], "k int, v int")
    found = sorted(r.v for r in joins.upsert(t, s, ("k",)).collect())
    assert found == [1, 1, 4, 4, 5]


def test_upsert_lets_null_keys_match_nothing(spark):
    t = spark.createDataFrame([(None, 1)], "k int, v int")
    s = spark.createDataFrame([(None, 2), (None, 3)], "k int, v int")
    assert sorted(r.v for r in joins.upsert(t, s, ("k",)).collect()) == [1, 2, 3]
