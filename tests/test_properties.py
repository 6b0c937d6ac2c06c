"""Property tests: line cutting and cell value coding round trips."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.functions import bytes4_to_int, bytes_to_text, chunk_text, int_to_bytes4, text_to_bytes

_TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\n\r"), max_size=60)


@settings(max_examples=20, deadline=None)
@given(st.lists(_TEXT, min_size=1, max_size=8), st.integers(1, 7))
def test_chunks_rejoin_to_the_line(spark, lines, n):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, s string")
    out = df.select("i", "s", chunk_text("s", n).alias("c")).collect()
    for r in out:
        assert "".join(r.c) == r.s
        assert all(len(p) <= n for p in r.c) and len(r.c) == max(1, -(-len(r.s) // n))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(-2**31, 2**31 - 1), _TEXT), min_size=1, max_size=10))
def test_codec_round_trip(spark, rows):
    df = spark.createDataFrame(rows, "x int, s string")
    back = df.select(
        bytes4_to_int(int_to_bytes4("x")).alias("x"),
        bytes_to_text(text_to_bytes("s")).alias("s"),
        F.length(int_to_bytes4("x")).alias("n"),
    ).collect()
    assert [(r.x, r.s) for r in back] == rows
    assert {r.n for r in back} == {4}
