import re
from collections import defaultdict
from itertools import permutations

import pytest

from tableflow.llm import filter_audit as A
from tests.llm.helpers import documents, odd_documents, words

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Every order applied document by document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    ids = defaultdict(list)
    for i, text, _ in rows:
        ids[text or ""].append(i)
    docs = []
    for i, text, source in rows:
        t, w = text or "", words(text)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": any(j is not None and i is not None and j < i for j in ids[t])}
        docs.append((source or "", i, {k for k, v in fails.items() if v}))
    out, shapley = {}, defaultdict(int)
    for order in permutations("ABCDE"):
        for part in {p for p, *_ in docs}:
            left = [(i, f) for p, i, f in docs if p == part]
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                shapley[part, name] += len(gone)
                every = [f for p, _, f in docs if p == part]
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(name in f for f in every) - len(gone), sum(f == {name} for f in every),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def answer(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in rows}
    assert len(got) == len(rows)
    return got


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    got = answer(A.audit(docs, labels))
    assert got == want
    assert any(v[4] for v in got.values()) and any(v[5] for v in got.values())


def test_odd_rows_nulls_and_clashing_columns(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (7, 1, 1), (None, 1, 1), (3, None, None)], LABELS)
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()],
                 [(1, 1, 0), (1, 0, 1), (7, 1, 1), (3, None, None)])
    assert answer(A.audit(docs, labels)) == want
    assert answer(A.audit(docs.limit(0), labels)) == {}
    assert answer(A.audit(docs, labels.limit(0))).keys() == want.keys()


def test_copies_by_id(spark):
    rows = [(5, "same"), (5, "same"), (2, "same"), (None, "same"), (9, "same"), (4, ""), (3, None), (8, "alone"), (8, "other")]
    df = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, source string").repartition(4)
    copies = sum(r.n for r in A.document_masks(df).collect() if r["mask"] & A.COPY)
    assert copies == 4  # twice 5, 9, and 4 after 3


def test_a_third_of_the_rows_are_one_text(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the hot text', concat('text ', id)) AS text",
                                      "'s' AS source").repartition(8)
    masks = A.document_masks(df).collect()
    assert sum(r.n for r in masks) == 3000
    assert sum(r.n for r in masks if r["mask"] & A.COPY) == 999


def test_the_sketch_clears_unique_texts_and_no_repeated_one(spark):
    df = spark.range(20_000).selectExpr("sha2(concat('t', CAST(IF(id < 500, id % 250, id) AS string)), 256) AS h").selectExpr(
        "unhex(h) AS digest").repartition(6).checkpoint()
    maybe = df.withColumn("maybe", A.possible_repeats(df, "digest", 20_000)).where("maybe")
    assert maybe.groupBy("digest").count().where("count > 1").count() == 250
    assert maybe.count() < 500 + 0.05 * 19_500


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 1)], LABELS)
    before = answer(A.audit(docs, labels))
    monkeypatch.setattr(A, "possible_repeats", lambda *a: A.F.lit(True))
    assert answer(A.audit(docs, labels)) == before


@pytest.mark.parametrize("text,mask", [("", 1), (None, 1), ("word " * 50, 2), (" ".join(f"w{k}" for k in range(50)), 0),
                                       (" ".join(f"W{k}" for k in range(50)), 4), ("a|b", 9), ("\x85 \xa0", 1), ("ÀÉ", 1)])
def test_own_text_rules(text, mask):
    assert A.failed_mask(text) == mask
