"""The registered corpus queries: SQL where there is some, a run over whole tables for the rest."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tableflow.llm import oracles, queries
from tests.llm.helpers import SF_SMALL

TABLES = "documents embeddings pages benchmark labels conversations".split()
NAMES = ["op1_quality_rules", "op2_source_mix", "op3_license_scan", "op4_best_fit_packing", "op5_embedding_dedup",
         "op6_language_id", "op7_url_rules", "op8_ngram_jaccard", "op9_sentence_spans", "op10_personal_data",
         "op11_filter_audit", "op12_bisector_clusters", "op13_word_bpe"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple(round(r[i], 9) if isinstance(r[i], float) and math.isfinite(r[i]) else r[i] for i in order) for r in data]
    return sorted(norm, key=lambda t: tuple(map(str, t)))


def test_all_are_registered():
    assert set(NAMES) | {"pipeline"} <= set(E.queries())
    assert set(queries.registry()) == set(NAMES)
    assert set(oracles.oracles()) <= set(NAMES)


@pytest.mark.parametrize("name", sorted(oracles.oracles()))
def test_query_matches_its_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(oracles.oracles()[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, df.collect()) == _rows(cols, res.fetchall())


@pytest.mark.parametrize("name,table", [("op5_embedding_dedup", "embeddings"), ("op6_language_id", "documents"),
                                        ("op8_ngram_jaccard", "documents"), ("op9_sentence_spans", "documents"),
                                        ("op10_personal_data", "documents"), ("op12_bisector_clusters", "embeddings"),
                                        ("op13_word_bpe", "documents")])
def test_a_row_for_every_row(spark, name, table):
    assert E.queries()[name](spark, SF_SMALL).count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", ["op3_license_scan", "op7_url_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
