import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tableflow.llm import license_index as L
from tableflow.llm.oracles import OP3
from tests.llm.helpers import odd_documents


def _scan(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in L.scan(df).collect()}


def test_phrases_places_and_labels(spark):
    got = _scan(spark, ["released UNDER the MIT-License, under the mit license", "Apache License, Version 2.0", "cc by nc cc-by-nc",
                        "under the mit licenses", "the mit license", None, "", "mit " * 50 + "under the mit license"])
    assert [(p.label, p.start) for p in got[0].places] == [("mit", 1), ("mit", 5)]
    assert got[0].base_labels == "mit" and got[0].n_words == 9 and got[0].score == 1.0
    assert [(p.label, p.start) for p in got[1].places] == [("apache-2", 0)]
    assert [(p.label, p.start) for p in got[2].places] == [("cc-by-nc", 0), ("cc-by-nc", 3)]
    for k in (3, 4, 5, 6):
        assert got[k].places == [] and got[k].base_labels == "" and got[k].labels == "" and got[k].score == 0.0
    assert [(p.label, p.start) for p in got[7].places] == [("mit", 50)]


def test_templates_need_key_phrase_and_relative_places(spark):
    mit = L.TEMPLATES[0].text
    got = _scan(spark, ["x " + mit, mit.replace("software", "program"), mit.replace("granted", "given"),
                        "This work is licensed under the GNU General Public License, version 3.", "All rights reserved.",
                        "reserved rights all"])
    assert got[0].labels == "mit" and got[0].base_labels == "" and got[0].score == 1.0 and got[0].found[0].start == 1
    assert got[1].labels == "mit" and 0.9 < got[1].score < 1
    assert got[2].labels == ""
    assert got[3].labels == "gpl-3" and got[4].labels == "all-rights-reserved" and got[5].labels == ""


def test_only_ascii_capitals_are_lowered(spark):
    got = _scan(spark, ["under the mıt license", "under the MİT license", "cc by nCé", "under the \u212ait license", "CC\x00BY\x7fNC"])
    assert all(got[k].base_labels == "" for k in range(4)) and got[4].base_labels == "cc-by-nc"


def test_every_place_is_found_whatever_is_rare(spark):
    """The index follows the corpus: here the phrase's words differ in frequency."""
    texts = ["under license"] * 30 + ["the mit"] * 3 + ["a under the mit license b under the mit license"] * 2
    got = _scan(spark, texts)
    assert [len(got[k].places) for k in range(33, 35)] == [2, 2] and not any(got[k].places for k in range(33))


def test_texts_that_begin_inside_a_template(spark):
    got = _scan(spark, ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GNU Lesser General Public License",
                        "the GNU Affero General Public License", "Mozilla Public License"])
    assert [[(f.label, f.start) for f in got[k].found] for k in range(4)] == [[("gpl-3", -3)], [("lgpl", -5)], [("agpl", -4)], []]
    assert got[0].score == 6 / 9 and got[1].score == 0.5 and got[0].labels == "gpl-3"


def test_notices_whose_tail_is_cut_off_keep_their_label(spark):
    """No other file lends the words that are missing, and none changes the labels."""
    cut = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    for others in ([], ["associated"], ["software and associated documentation files"] * 3):
        got = _scan(spark, [cut, *others])
        assert got[0].labels == "mit" and got[0].score == 0.65


def test_notices_titles_and_identifiers(spark):
    texts = {
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License": "gpl-3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2": "gpl-2",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted": "",
        "// SPDX-License-Identifier: MIT": "mit", "# SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3",
        "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by-sa", "Mozilla Public License Version 2.0": "mpl-2",
        "Attribution-ShareAlike 4.0 International": "cc-by-sa",
        "* Redistributions of source code must retain the above copyright notice, this list of conditions": "bsd",
        "GNU General Public License as published by the Free Software Foundation, either way": "",
        "the license identifier of the mit": "",
    }
    got = _scan(spark, list(texts))
    assert [got[k].labels for k in range(len(texts))] == list(texts.values())


def test_the_intersection_decides_what_is_verified(spark):
    """Starts come only from agreement of all of a template's rare words."""
    words = L.template_words("spdx x license x identifier x mit  spdx license identifier mit  identifier license spdx")
    df = spark.createDataFrame([(words,)], "w array<string>")
    t = [x for x in L.TEMPLATES if x.key.startswith("SPDX")][:1]
    chosen = [L.rare_places(t[0], {}, 3)]
    assert len(set(chosen[0])) == 3
    got = df.select(L._candidates(F.col("w"), t, chosen).alias("c")).first().c
    assert [c - L._SHIFT for c in got] == [7]
    one = df.select(L._candidates(F.col("w"), t, [c[:1] for c in chosen]).alias("c")).first().c
    assert len(one) == 3


def test_a_file_full_of_one_rare_word(spark):
    got = _scan(spark, ["spdx " * 30_000 + "license identifier mit", "mit " * 30_000])
    assert got[0].labels == "mit" and got[1].labels == ""


def test_query_and_sql_agree_on_texts_cut_at_either_end(spark):
    rng = random.Random(3)
    rows = []
    for t in (*L.PHRASES, *L.TEMPLATES):
        w = t.words
        for _ in range(6):
            a, b = sorted(rng.sample(range(len(w) + 1), 2))
            pad = rng.choice([[], ["x"], ["license"], ["the", "gnu"]])
            rows.append((len(rows), " ".join([*rng.choice([[], pad]), *w[a:b], *rng.choice([[], pad])])))
        rows.append((len(rows), " - ".join(w).upper()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = L.scan(docs)
    got = sorted((r.doc_id, r.n_words, len(r.places), r.base_labels, r.labels, round(r.score, 9)) for r in out.collect())
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    cur = con.execute(OP3)
    names = [c[0] for c in cur.description]
    want = sorted((r["doc_id"], r["n_words"], r["n_base"], r["base_labels"], r["labels"], round(r["score"], 9))
                  for r in (dict(zip(names, x)) for x in cur.fetchall()))
    assert got == want and sum(bool(r[4]) for r in got) > 60


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = L.scan(df).collect()
    assert len(rows) == df.count() and sum(r.base_labels == "mit" for r in rows) == 1
    assert L.scan(df.limit(0)).count() == 0
