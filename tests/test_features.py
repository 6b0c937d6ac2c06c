import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tableflow.operators import assemble, fit_labels, index_labels, one_hot, read_labels, string_index
from tableflow.session import scratch_path
from tests.conftest import SF_SMALL


def test_frequency_index_and_one_hot(spark):
    # X4
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("a",), ("a",), ("c",)], "cate_col string")
    idx = string_index(df, "cate_col", "cate_col_idx")
    got = {r.cate_col: r.cate_col_idx for r in idx.collect()}
    assert got == {"a": 0.0, "c": 1.0, "b": 2.0}
    enc = one_hot(idx, "cate_col_idx", "vec", as_columns=True)
    rows = {r.cate_col: (r.vec_0, r.vec_1) for r in enc.collect()}
    assert rows == {"a": (1.0, 0.0), "c": (0.0, 1.0), "b": (0.0, 0.0)}
    feats = assemble(one_hot(idx, "cate_col_idx", "vec"), ["cate_col_idx", "vec"], as_array=True)
    assert {tuple(r.features) for r in feats.collect()} == {(0.0, 1.0, 0.0), (1.0, 0.0, 1.0), (2.0, 0.0, 0.0)}


def test_null_label_handling(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "c string")
    keep = sorted(((r.c, r.c_idx) for r in string_index(df, "c", handle_invalid="keep").collect()), key=str)
    assert keep == sorted([("a", 0.0), ("a", 0.0), ("b", 1.0), (None, 2.0)], key=str)
    assert string_index(df, "c", handle_invalid="skip").count() == 3
    with pytest.raises(Exception):
        string_index(df, "c").collect()


def test_matches_ml_string_indexer(spark):
    # frequency ties are broken alphabetically, many partitions of labels
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").select("p_type", "p_name")
    ours = string_index(part, "p_name", "i").select("p_name", "i").distinct()
    ml = StringIndexer(inputCol="p_name", outputCol="i", stringOrderType="frequencyDesc").fit(part)
    theirs = ml.transform(part).select("p_name", "i").distinct()
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    assert ours.agg(F.max("i")).first()[0] == len(ml.labels) - 1


def test_one_hot_without_metadata_fits(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (1.0,)], "i double")
    cols = one_hot(df, "i", "v", as_columns=True)
    assert cols.columns == ["i", "v_0", "v_1"]
    assert [(r.v_0, r.v_1) for r in cols.collect()] == [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 1.0)]


def _fitted(spark, rows=("a", "b", "a", "c", "c", "a", None)):
    path = scratch_path(spark, "labels")
    fit_labels(spark.createDataFrame([(x,) for x in rows], "c string"), "c", path)
    return read_labels(spark, path)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_a_fitted_dictionary_indexes_another_table(spark, monkeypatch, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        labels = _fitted(spark)
        other = spark.createDataFrame([("c", 1), ("zz", 2), (None, 3), ("a", 4), ("a", 4), ("", 5)], "name string, `x.y` int")
        keep = index_labels(other, labels, "name", "i", handle_unseen="keep")
        assert keep.columns == ["name", "x.y", "i"]
        assert sorted((r[1], r.i) for r in keep.collect()) == [(1, 1.0), (2, 3.0), (3, 3.0), (4, 0.0), (4, 0.0), (5, 3.0)]
        skip = index_labels(other, labels, "name", "i", handle_unseen="skip")
        assert sorted((r[1], r.i) for r in skip.collect()) == [(1, 1.0), (4, 0.0), (4, 0.0)]
        with pytest.raises(Exception, match="not in the dictionary"):
            index_labels(other, labels, "name").collect()
        assert index_labels(other.limit(0), labels, "name").count() == 0
        # the index carries the number of labels: encoders need no pass over the data
        assert one_hot(keep, "i", "v", as_columns=True).columns == ["name", "x.y", "i", "v_0", "v_1", "v_2"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_an_empty_dictionary_and_other_types(spark):
    labels = _fitted(spark, (None,))
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r.c_idx for r in index_labels(df, labels, "c", handle_unseen="keep").collect()] == [0.0, 0.0]
    path = scratch_path(spark, "labels")
    numbers = fit_labels(spark.createDataFrame([(5,), (5,), (7,)], "n long"), "n", path)
    text = spark.createDataFrame([("5",), ("7",), ("x",)], "n string")
    assert [r.n_idx for r in index_labels(text, numbers, "n", handle_unseen="keep").collect()] == [0.0, 1.0, 2.0]
    with pytest.raises(ValueError):
        index_labels(df, labels, "c", handle_unseen="guess")


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_a_stream_is_indexed_by_a_stored_dictionary(spark, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        labels, spool, root = _fitted(spark), scratch_path(spark, "spool"), scratch_path(spark, "out")
        stream = spark.readStream.schema("c string, n int").parquet(spool + "/*")
        for batch, rows in enumerate([[("a", 1), ("new", 2)], [("c", 3), (None, 4)]]):
            spark.createDataFrame(rows, "c string, n int").write.parquet(f"{spool}/{batch}")
            indexed = index_labels(stream, labels, "c", handle_unseen="keep")
            (indexed.writeStream.format("parquet").option("checkpointLocation", root + "/ck").trigger(availableNow=True)
             .start(root + "/data").awaitTermination())
        assert sorted((r.n, r.c_idx) for r in spark.read.parquet(root + "/data").collect()) == [(1, 0.0), (2, 3.0), (3, 1.0), (4, 3.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
