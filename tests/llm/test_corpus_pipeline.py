"""Every stage of the pipeline against a brute-force version, on its own input."""

import os
from collections import Counter, defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from tableflow.llm import pii
from tests.llm.helpers import SF_SMALL, jaccard_classes, odd_documents, words
from tests.llm.test_quality_ledger import brute as measure


def _passes(text):
    m = measure(text)
    return not (m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"] or 100 * m["n_symbols"] > 30 * m["n_words"]
                or 100 * m["n_dup_lines"] > 40 * m["n_lines"] or 100 * m["n_adjacent"] > 20 * m["n_words"]
                or 100 * m["n_capitals"] > 50 * m["n_letters"] or m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 15 * m["n_words"])


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, stages = docs.columns, dict(C.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard", "personal_data", "source_mix", "best_fit_packing"]
    held = [tuple(r) for r in docs.collect()]

    def through(name):
        nonlocal docs
        stages[name](spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        return [tuple(r) for r in docs.collect()]

    got = through("quality_rules")
    assert docs.columns == columns and sorted(got) == sorted(r for r in held if _passes(r[1]))
    held = sorted(got)
    classes, _ = jaccard_classes([r[1] for r in held], 5, 80)
    got = through("ngram_jaccard")
    assert docs.columns == columns and sorted(got) == [held[k] for k in range(len(held)) if classes[k] == k]
    held = sorted(got)
    got = through("personal_data")
    assert docs.columns == columns
    assert sorted(got) == [(i, t, *rest, len(t)) for i, t, *rest, _ in ((r[0], pii.redact(r[1]), *r[2:]) for r in held)]
    assert not any(pii.plain_spans(r[1]) for r in got)
    held = sorted(got)
    got = through("source_mix")
    assert docs.columns == columns
    taken, size = defaultdict(int), {r[0]: len(words(r[1])) for r in held}
    for r in got:
        taken[r[0]] += len(words(r[1]))
    assert all(n <= 3 * size[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - sum(size.values())) <= 64 * 20
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r[0], len(slow.encode(r[1], add_special_tokens=False).ids) + 1) for r in got)
    through("best_fit_packing")
    pieces = docs.collect()
    assert sum(p.length for p in pieces) == sum(n * c for (_, n), c in want.items())
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_run_equals_its_stages(spark):
    out = C.run(spark, SF_SMALL)
    assert out.columns[:3] == ["doc_id", "piece", "start"] and out.count() > 0


def test_odd_rows_pass_every_stage(spark):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns, name
            out.collect()
        C.STAGES[-1][1](spark, docs, SF_SMALL).collect()


def test_import_errors_are_not_swallowed():
    source = open(os.path.join(os.path.dirname(C.__file__), "corpus_pipeline.py"), encoding="utf-8").read()
    assert "ImportError" not in source and "ModuleNotFoundError" not in source
