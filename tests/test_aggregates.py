import pytest

from tableflow.operators import aggregate, distinct_values, top_n


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [("Low", "a", 10, "x"), ("Low", "b", 20, "x"), ("High", "c", 300, "y"), ("High", None, None, "z")],
        "prize_range string, name string, prices int, cat string",
    )


def test_flat_and_nested(spark, sales):
    out = aggregate(sales, "prize_range", {
        "name": {"no_of_house": "count"},
        "prices": {"min_price": "min", "max_price": "max", "avg_price": "mean", "total": "sum"},
        "cat": "countDistinct",
    })
    assert out.columns == ["prize_range", "no_of_house", "min_price", "max_price", "avg_price", "total", "cat"]
    got = {r.prize_range: r.asDict() for r in out.collect()}
    assert got["Low"]["no_of_house"] == 2 and got["Low"]["avg_price"] == 15.0 and got["Low"]["cat"] == 1
    assert got["High"]["no_of_house"] == 1 and got["High"]["total"] == 300 and got["High"]["cat"] == 2


def test_global_group(spark, sales):
    r = aggregate(sales, [], {"prices": {"n": "count", "s": "sum"}}).collect()
    assert len(r) == 1 and r[0].n == 3 and r[0].s == 330


def test_unknown_function(spark, sales):
    with pytest.raises(ValueError, match="allowed"):
        aggregate(sales, "prize_range", {"prices": "median-ish"})


def test_top_n_and_distinct(spark, sales):
    assert [r.prices for r in top_n(sales, 2, "prices", tie_breaker=["name"]).collect()] == [300, 20]
    assert distinct_values(sales, ["prize_range"]).count() == 2
