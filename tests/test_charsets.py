"""Charset advice from byte pairs, against counts and logs in plain Python."""

import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableflow.operators.charsets import byte_pairs, charset_advice, charset_scores, fit_charsets
from tableflow.session import scratch_path

TEXTS = {
    "windows-1252": "El niño comió piñas y mañana irá a España — “señor”\nL'été à la forêt où naît le cœur\nÜber größere Äpfel für Mädchen",
    "ISO-8859-2": "Zażółć gęślą jaźń i ślimak\nŁódź leży nad rzeką Łódką\nPříliš žluťoučký kůň úpěl ďábelské ódy",
    "UTF-8": "El niño comió piñas\nZażółć gęślą jaźń\nÜber größere Äpfel\nL'été à la forêt",
    "UTF-16LE": "El niño comió piñas\nZażółć gęślą jaźń\nplain words here\nand more of them",
    "UTF-16BE": "El niño comió piñas\nZażółć gęślą jaźń\nplain words here\nand more of them",
}
NEW = {"windows-1252": "La niña mañana à l'été “où”", "ISO-8859-2": "gęś żółta, kůň žlutý, Łódź", "UTF-8": "niña żółta été",
       "UTF-16LE": "more words and gęś żółta", "UTF-16BE": "more words and gęś żółta"}


def _lines(spark, texts, times=3):
    rows = [(c, bytearray(x.encode(c))) for c, t in texts.items() for _ in range(times) for x in t.split("\n")]
    return spark.createDataFrame(rows, "name string, value binary").repartition(4)


def _pairs(values):
    out = Counter()
    for v in values:
        wrapped = b"\n" + v + b"\n"
        out.update(a * 256 + b for a, b in zip(wrapped, wrapped[1:]))
    return out


def test_counts_and_scores_equal_plain_python(spark):
    lines = _lines(spark, TEXTS)
    want = {c: _pairs([x.encode(c) for x in t.split("\n")] * 3) for c, t in TEXTS.items()}
    got = {(r.name, r.pair): r.n for r in byte_pairs(lines, "name").where("pair >= 0").collect()}
    assert got == {(c, p): n for c, counts in want.items() for p, n in counts.items()}
    model = fit_charsets(lines, "name").checkpoint()
    score = {(r.charset, r.pair): r.score for r in model.collect()}
    total = {c: sum(n.values()) for c, n in want.items()}
    for c, counts in want.items():
        assert score[c, -1] == round(1000 * math.log(0.5 / (total[c] + 32768)))
        assert all(score[c, p] == round(1000 * math.log((n + 0.5) / (total[c] + 32768))) for p, n in counts.items())
    fresh = _lines(spark, NEW, 1)
    for r in charset_scores(fresh, model, "name").collect():
        counts = _pairs([NEW[r.name].encode(r.name)])
        assert r.score == sum(n * score.get((r.charset, p), score[r.charset, -1]) for p, n in counts.items())
        assert r.n_bytes == sum(counts.values())


def test_spool_files_of_five_charsets_are_named(spark):
    root = scratch_path(spark, "charsets").removeprefix("file:")
    for c, text in NEW.items():
        os.makedirs(f"{root}/{c}")
        with open(f"{root}/{c}/f.txt", "wb") as f:
            f.write((text + "\n").encode(c) * 20)
    # as a flow reads it: lines end at line feed bytes, whatever the charset
    raw = spark.read.option("lineSep", "\n").text(f"{root}/*").select("value", F.element_at(F.split("_metadata.file_path", "/"), -2).alias("dir"))
    advice = charset_advice(raw, fit_charsets(_lines(spark, TEXTS), "name"), "dir").collect()
    assert {r.name: r.charset for r in advice} == {c: c for c in NEW}
    assert all(r.margin > 0 for r in advice)


def test_odd_lines(spark):
    model = fit_charsets(_lines(spark, TEXTS), "name").checkpoint()
    rows = [("plain", b"only seven bits"), ("plain", None), (None, "mañana el niño".encode("cp1252")), ("empty", b""), ("mixed", "piñas".encode()), ("mixed", b"\xff\xfe\xfd"),
            ("zero", b"a\x00b\x00")]
    df = spark.createDataFrame([(n, None if v is None else bytearray(v), 1) for n, v in rows], "name string, value binary, pair int")
    got = {r.name: r for r in charset_advice(df, model, "name").collect()}
    assert set(got) == {"plain", "", "empty", "mixed", "zero"}
    assert got["plain"].charset == "US-ASCII" and got["plain"].n_bytes == 17 and got["empty"].charset == "US-ASCII"
    assert got[""].charset == "windows-1252" and got["mixed"].charset != "UTF-8" and got["zero"].charset.startswith("UTF-16")
    assert charset_advice(df.limit(0), model, "name").count() == 0
    with pytest.raises(ValueError, match="no charset"):
        charset_scores(df, model.limit(0), "name")


def test_a_hot_file_is_added_up_before_the_shuffle(spark):
    lines = spark.range(40_000).selectExpr("IF(id % 3 = 0, 'other', 'hot') AS name", "CAST('the same line' AS binary) AS value").coalesce(2)
    pairs = byte_pairs(lines, "name")
    assert {r.name: r.n for r in pairs.groupBy("name").agg(F.sum("n").alias("n")).collect()} == {"hot": 26666 * 14, "other": 13334 * 14}
    assert "MapInArrow" in pairs._jdf.queryExecution().executedPlan().toString()
