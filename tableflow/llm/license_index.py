"""License scan by a positional rare-token index (DataFrame functions only).

A template is a passage of a license or notice with mandatory phrases in it.  The
index holds, for the rarest words of these phrases (``RARE_WORDS`` of them), the
template and the word's place; rarity is the document frequency measured over the
scanned corpus.  A file's words are looked up: each posting says where the template
would have to start, one list of such starts for each rank of rarity.  The lists
are intersected, so a start stays only where all of a template's rare words agree,
and only such starts are verified: first the mandatory phrases, then the share of
the template's other words.  As the rare words stand in mandatory phrases, no place
is passed over, whatever the corpus holds.  Everything happens inside the file's
own row: the scan has no shuffle, and the document-frequency pass one of at most a
vocabulary of rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import ascii_lower, col, fresh

#: Separators: ASCII that is neither digit nor lower-case letter (after lower-casing A-Z).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """License words; the phrases of ``key``, parted by ``...``, must stand exactly at their places."""

    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return template_words(self.text)

    @property
    def pieces(self) -> list[tuple[int, list[str]]]:
        """Place and words of every mandatory phrase, one after the other."""
        w, out, at = self.words, [], 0
        for piece in self.key.split("..."):
            k = template_words(piece)
            at = next(i for i in range(at, len(w) - len(k) + 1) if w[i:i + len(k)] == k)
            out.append((at, k))
            at += len(k)
        return out


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


#: Exact phrases and their labels.
PHRASES = (
    Template("mit", "under the mit license", "under the mit license"),
    Template("apache-2", "apache license version 2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc", "cc by nc"),
)

#: Passages of public licenses and notices (fixed values): opening or granting sentences, notices, titles.
PASSAGES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files", "permission is hereby granted free of charge"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted", "permission to use copy modify and ... distribute this software for any purpose with or without fee"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
     "except in compliance with the License", "you may not use this file except in compliance with the license"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
     "following disclaimer", "redistributions of source code must retain"),
    ("gpl-3", "licensed under the GNU General Public License, version 3", "gnu general public license version 3"),
    ("gpl-2", "licensed under the GNU General Public License, version 2", "gnu general public license version 2"),
    ("gpl-3", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
     "gnu general public license as published by the free software foundation ... version 3"),
    ("gpl-2", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
     "gnu general public license as published by the free software foundation ... version 2"),
    ("lgpl", "under the terms of the GNU Lesser General Public License", "gnu lesser general public license"),
    ("agpl", "under the terms of the GNU Affero General Public License", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    ("mpl-2", "Mozilla Public License Version 2.0", "mozilla public license version 2 0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0", "cc by nd"),
    ("cc-by", "Creative Commons Attribution 4.0 International License", "creative commons attribution 4 0"),
    ("cc-by-sa", "Attribution-ShareAlike 4.0 International", "attribution sharealike 4 0 international"),
    ("cc-by-nd", "Attribution-NoDerivatives 4.0 International", "attribution noderivatives 4 0 international"),
    ("cc-by-nc", "Attribution-NonCommercial 4.0 International", "attribution noncommercial 4 0 international"),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved.", "all rights reserved"),
)
#: Identifiers of one-line notices (fixed values), after the words that introduce them.
IDENTIFIER_LINE = "SPDX-License-Identifier:"
IDENTIFIERS = (("mit", "MIT"), ("isc", "ISC"), ("apache-2", "Apache-2.0"), ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"),
               ("gpl-3", "GPL-3.0"), ("gpl-2", "GPL-2.0"), ("lgpl", "LGPL"), ("agpl", "AGPL"), ("mpl-2", "MPL-2.0"),
               ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA"), ("cc-by-nd", "CC-BY-ND"), ("cc-by-nc", "CC-BY-NC"),
               ("unlicense", "Unlicense"))
TEMPLATES = (*(Template(*p) for p in PASSAGES),
             *(Template(label, f"{IDENTIFIER_LINE} {name}", f"{IDENTIFIER_LINE} {name}") for label, name in IDENTIFIERS))
#: Rare words of a template's mandatory phrases that are indexed.
RARE_WORDS = 3
#: Added to starts, which are below 0 where a file begins inside a template; templates are shorter.
_SHIFT = 1 << 16
#: Share of a template's words that must stand at their places.
MIN_MATCH = 0.5


def words_column(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), "")


def word_frequencies(docs: DataFrame, vocabulary: Sequence[str], text_col: str = "text") -> dict[str, int]:
    """Documents of the corpus that hold each word; a result row per vocabulary word at most."""
    held = F.array_intersect(words_column(col(text_col)), F.array(*[F.lit(w) for w in sorted(vocabulary)]))
    rows = docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    return {r["w"]: r["n"] for r in rows}


def rare_places(template: Template, idf: dict[str, float], n: int) -> list[int]:
    """Places in the template of the ``n`` rarest distinct words of its mandatory phrases, rarest first; ties to the earlier place."""
    first: dict[str, int] = {}
    for at, words in template.pieces:
        for i, w in enumerate(words):
            first.setdefault(w, at + i)
    return [first[w] for w in sorted(first, key=lambda w: (-idf.get(w, math.inf), first[w]))[:n]]


def _strings(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _lookup(words: Column, places: dict[str, list[tuple[int, int]]]) -> Column:
    """``template * 2**32 + start`` (shifted) for every indexed word of the row."""
    anchors = _strings(sorted(places))
    posting = F.create_map(*[x for w in sorted(places) for x in (
        F.lit(w), F.array(*[F.lit(t * (1 << 32) + _SHIFT - 1 - p).cast("long") for t, p in places[w]]))])
    at = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains(anchors, F.element_at(words, i)))
    return F.flatten(F.transform(at, lambda i: F.transform(F.element_at(posting, F.element_at(words, i)), lambda q: q + i)))


def _candidates(words: Column, templates: Sequence[Template], chosen: Sequence[list[int]]) -> Column:
    """Starts on which the postings of all rare words of a template agree.

    The words of each rank of rarity are one list of postings; a template with
    fewer rare words is in the other lists by its rarest.
    """
    ranks: list[dict[str, list[tuple[int, int]]]] = []
    for r in range(max(map(len, chosen))):
        held: dict[str, list[tuple[int, int]]] = {}
        for k, (t, places) in enumerate(zip(templates, chosen)):
            p = places[r] if r < len(places) else places[0]
            held.setdefault(t.words[p], []).append((k, p))
        ranks.append(held)
    agreed = F.array_distinct(_lookup(words, ranks[0]))
    for held in ranks[1:]:
        agreed = F.array_intersect(agreed, _lookup(words, held))
    any_anchor = F.lit(True)
    for held in ranks:  # most files have no word of some rank
        any_anchor = any_anchor & F.arrays_overlap(words, _strings(sorted(held)))
    return F.when(any_anchor, agreed).otherwise(F.array().cast("array<bigint>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Sequence[Template] = PHRASES,
         templates: Sequence[Template] = TEMPLATES, rare_words: int = RARE_WORDS,
         min_match: float = MIN_MATCH) -> DataFrame:
    """``id_col, n_words, places, found, base_labels, labels, score``: one row per input row.

    ``places`` lists every exact place of a phrase (``label, start``), ``found``
    every verified template place (``label, start, matched``, the share of its
    words that stand in place).  A text may begin or end inside a template: its
    words beyond the text count as missing, and ``start`` can be below 0.  Labels are distinct, sorted and comma-joined, ''
    if none; ``score`` is 1 with an exact phrase, else the best ``matched``, else
    0.  A null text is empty; null ids and repeated rows stay; an empty table
    gives an empty result; other columns are not carried.
    """
    vocabulary = {w for t in (*phrases, *templates) for w in t.words}
    frequency = word_frequencies(docs, sorted(vocabulary), text_col)
    idf = {w: -math.log(frequency.get(w, 0) + 1.0) for w in vocabulary}

    out_id = fresh(["n_words", "places", "found", "base_labels", "labels", "score"], id_col)
    files = docs.select(col(id_col).alias("_id"), words_column(col(text_col)).alias("_words"))
    words = F.col("_words")

    def candidates(of: Sequence[Template]) -> Column:
        return _candidates(words, of, [rare_places(t, idf, rare_words) for t in of])

    files = files.select("_id", "_words", candidates(phrases).alias("_exact"), candidates(templates).alias("_fuzzy"))

    def listed(of: Sequence[Template]) -> Column:
        return F.array(*[F.struct(F.lit(t.label).alias("label"), _strings(t.words).alias("words"), F.array(*[
            F.struct(F.lit(at).alias("at"), _strings(k).alias("words")) for at, k in t.pieces]).alias("pieces")) for t in of])

    exact_list, fuzzy_list = listed(phrases), listed(templates)

    def template_of(c: Column, held: Column) -> Column:
        return F.element_at(held, (F.shiftright(c, 32) + 1).cast("int"))

    def start_of(c: Column) -> Column:
        return c.bitwiseAND(F.lit((1 << 32) - 1)).cast("int") - _SHIFT

    def word_at(place: Column) -> Column:
        return F.get(F.col("_words"), place)

    def verified(c: Column, held: Column) -> Column:
        def stands(piece: Column) -> Column:
            first, phrase = start_of(c) + piece.getField("at"), piece.getField("words")
            return F.when(first >= 0, F.slice(F.col("_words"), first + 1, F.size(phrase)) == phrase).otherwise(F.lit(False))
        return F.forall(template_of(c, held).getField("pieces"), stands)

    def scored(c: Column) -> Column:
        t, s = template_of(c, fuzzy_list), start_of(c)
        hits = F.filter(F.transform(t.getField("words"), lambda w, i: word_at(s + i) == w), lambda same: same)
        return F.struct(t.getField("label").alias("label"), s.cast("long").alias("start"),
                        (F.size(hits) / F.size(t.getField("words"))).alias("matched"))

    places = F.transform(F.array_sort(F.filter("_exact", lambda c: verified(c, exact_list))), lambda c: F.struct(
        template_of(c, exact_list).getField("label").alias("label"), start_of(c).cast("long").alias("start")))
    found = F.filter(F.transform(F.array_sort(F.filter("_fuzzy", lambda c: verified(c, fuzzy_list))), scored),
                     lambda f: f.getField("matched") >= min_match)
    out = files.select(F.col("_id").alias(out_id), F.size("_words").cast("long").alias("n_words"),
                       places.alias("places"), found.alias("found"))

    def joined(c: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(c)), ",")

    base, more = F.col("places.label"), F.col("found.label")
    return out.select("*", joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"),
                      F.when(F.size("places") > 0, F.lit(1.0))
                      .otherwise(F.coalesce(F.array_max("found.matched"), F.lit(0.0))).alias("score"))
