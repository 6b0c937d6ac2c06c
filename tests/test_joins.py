import pytest
from pyspark.sql import functions as F

from tableflow.operators import join_alias, join_mapped, join_on
from tableflow.operators.joins import _dealt, hot_keys, split_skew_join


@pytest.fixture(scope="module")
def n1(spark):
    left = spark.createDataFrame([(1, "l1"), (2, "l2"), (None, "lnull")], "k int, lv string")
    right = spark.createDataFrame([(1, "r1", "x"), (3, "r3", "y"), (None, "rnull", "z")], "k int, rv string, lv string")
    return left, right


def test_using_one_and_list(spark, n1):
    left, right = n1
    r = right.select("k", "rv")
    got = sorted(((x.k, x.lv, x.rv) for x in join_on(left, r, "k").collect()), key=str)
    assert got == sorted([(1, "l1", "r1"), (2, "l2", None), (None, "lnull", None)], key=str)
    assert join_on(left, r, ["k"], how="inner").count() == 1


def test_clash_raises_and_suffix(spark, n1):
    left, right = n1
    with pytest.raises(ValueError, match="lv"):
        join_on(left, right, "k")
    out = join_on(left, right, "k", suffix="_r")
    assert out.columns == ["k", "lv", "rv", "lv_r"]


def test_mapped_renames_clashing_key_and_drops(spark, n1):
    left, right = n1
    r = right.select("k", "rv")
    out = join_on(left, r, {"k": "k"})
    assert out.columns == ["k", "lv", "rv"]
    keep = join_on(left, r, {"k": "k"}, drop=False)
    assert keep.columns == ["k", "lv", "k_", "rv"]


@pytest.mark.parametrize("how,expected", [
    ("inner", [(1, "l1", "r1")]),
    ("left", [(1, "l1", "r1"), (2, "l2", None), (None, "lnull", None)]),
    ("right", [(1, "l1", "r1"), (3, None, "r3"), (None, None, "rnull")]),
    ("full", [(1, "l1", "r1"), (2, "l2", None), (3, None, "r3"), (None, "lnull", None), (None, None, "rnull")]),
])
def test_mapped_join_types_keep_right_keys(spark, n1, how, expected):
    left, right = n1
    r = right.select("k", "rv")
    got = sorted(((x.k, x.lv, x.rv) for x in join_on(left, r, {"k": "k"}, how=how).collect()), key=str)
    assert got == sorted(expected, key=str)


def test_semi_anti(spark, n1):
    left, right = n1
    r = right.select("k")
    assert [x.lv for x in join_on(left, r, {"k": "k"}, how="left_semi").collect()] == ["l1"]
    assert sorted(x.lv for x in join_on(left, r, "k", how="anti").collect()) == ["l2", "lnull"]


def test_join_alias_does_not_mutate():
    on = {"prize_range": "prize_range", "price_category": "category"}
    out = join_alias(on, {"prize_range": "RANGE_RENAMED"})
    assert out == {"prize_range": "RANGE_RENAMED", "price_category": "category"}
    assert on == {"prize_range": "prize_range", "price_category": "category"}
    assert join_alias(["a"], {"a": "b"}) == ["a"]


def test_composite_map_renames_and_drops_right_keys(spark):
    left = spark.createDataFrame([(1, "x", 5), (1, "y", 6), (2, "x", 7), (None, "x", 8), (2, None, 9)],
                                 "shop int, item string, sold int")
    right = spark.createDataFrame([(1, "x", "red", 0), (2, "x", "blue", 0), (2, "y", "green", 0), (None, "x", "grey", 0)],
                                  "shop int, article string, colour string, unused int")
    out = join_mapped(left, right, {"shop": "shop", "item": "article"}, sel=["shop", "article", "colour"], rename={"colour": "hue"})
    assert out.columns == ["shop", "item", "sold", "hue"]
    assert {r.sold: r.hue for r in out.collect()} == {5: "red", 6: None, 7: "blue", 8: None, 9: None}
    kept = join_mapped(left, right, {"shop": "shop", "item": "article"}, sel=["shop", "article", "colour"],
                       rename={"colour": "hue", "shop": "place"}, drop=False)
    assert kept.columns == ["shop", "item", "sold", "hue", "place", "article"]


def test_bad_join_type(spark, n1):
    left, right = n1
    with pytest.raises(ValueError):
        join_on(left, right.select("k"), "k", how="sideways")


HOWS = ["inner", "left", "right", "full", "left_semi", "left_anti"]


def _same(got, want):
    assert got.columns == want.columns
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("how", HOWS)
def test_split_skew_join_equals_plain_join(spark, how):
    # one key holds a third of the rows
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") == 1, F.lit(None)).otherwise(F.col("id") % 50)
        .alias("k"), F.col("id").alias("v")
    )
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    assert (7,) in hot_keys(left, ["k"], 0.2)
    _same(split_skew_join(left, right, "k", how=how, buckets=8, min_share=0.2), left.join(right, "k", how))


@pytest.mark.parametrize("how", HOWS)
def test_hot_keys_on_either_side_with_and_without_partner(spark, how):
    # hot on the left: 'a' (partner), 'b' (none); on the right: 'c' (partner), 'd' (none); on both: 'e', NULL
    left = spark.createDataFrame([(k, n % 2, i) for k, n in [("a", 300), ("b", 300), ("c", 2), ("e", 30), (None, 200), ("x", 3), ("y", 1)]
                                  for i, n in enumerate(range(n))], "k string, g int, v int").repartition(5)
    right = spark.createDataFrame([(k, n % 2, i) for k, n in [("a", 3), ("c", 300), ("d", 300), ("e", 30), (None, 200), ("x", 2), ("z", 1)]
                                   for i, n in enumerate(range(n))], "k string, g int, w int").repartition(3)
    _same(split_skew_join(left, right.drop("g"), "k", how, buckets=4, min_share=0.03), left.join(right.drop("g"), "k", how))
    _same(split_skew_join(left, right, ["k", "g"], how, buckets=4, min_share=0.03), left.join(right, ["k", "g"], how))


@pytest.mark.parametrize("how", HOWS)
def test_named_hot_keys_may_be_absent(spark, how):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    right = spark.createDataFrame([(1, "p"), (3, "q"), (9, "r"), (None, "s")], "k long, w string")
    _same(split_skew_join(left, right, "k", how, hot=[(1,), (3,), (8,), (None,)], buckets=3), left.join(right, "k", how))
    empty = left.limit(0)
    _same(split_skew_join(empty, right, "k", how), empty.join(right, "k", how))
    _same(split_skew_join(left, right.limit(0), "k", how), left.join(right.limit(0), "k", how))


def test_no_task_gets_more_than_its_share_of_a_hot_key(spark):
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))
    right = right.union(spark.createDataFrame([(0, 1)], "k long, w long"))
    hot = split_skew_join(left, right, "k", "full", buckets=16, min_share=0.1).where("k = 0")
    per_task = hot.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 2000
    dealt = _dealt(left.withColumn("_skew_place", F.monotonically_increasing_id()), ["k"], "own", "other", [(0,)], [], 16)
    sizes = [r["count"] for r in dealt.where("k = 0").groupBy("own").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * 2000 / 16


def test_a_side_that_is_computed_anew_each_time_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def count(v):
        seen.add(1)
        return v

    left = spark.range(900).select((F.col("id") % 3).alias("k"), count("id").alias("v"))
    right = spark.createDataFrame([(0, "x")], "k long, w string")
    assert split_skew_join(left, right, "k", "full", min_share=0.2).count() == 900
    assert seen.value == 900


def test_other_columns_on_both_sides_raise(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="both join sides"):
        split_skew_join(df, df, "k", "full")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti", "full"])
def test_self_join_by_key_map(spark, how):
    # parent/child rows of one frame: join child.parent -> parent.id
    t = spark.createDataFrame([(1, None, "root"), (2, 1, "a"), (3, 1, "b"), (4, 9, "orphan")],
                              "id int, parent int, name string")
    parents = t.select("id", t["name"].alias("parent_name"))
    out = join_on(t, parents, {"parent": "id"}, how=how)
    want = {"inner": 2, "left": 4, "left_semi": 2, "left_anti": 2, "full": 7}[how]
    assert out.count() == want


def test_join_mapped_duplicate_right_names_raise(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1, "x", "y")], "rk int, p string, q string")
    with pytest.raises(ValueError, match="duplicate"):
        join_mapped(left, right, {"k": "rk"}, sel=["rk", "p", "q"], rename={"p": "q"})


def test_hot_keys_bounds(spark):
    df = spark.range(100).selectExpr("id % 4 AS k")
    assert sorted(hot_keys(df, ["k"], 0.2)) == [(0,), (1,), (2,), (3,)]
    assert hot_keys(df, ["k"], 0.5) == []
    with pytest.raises(ValueError):
        hot_keys(df, ["k"], 0)
