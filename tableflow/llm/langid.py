"""Language identification by words, with character n-grams for unseen words.

A word that the model knows is scored by its log frequency in each language.
An unseen word falls back to its character n-grams, longest first: the first
length at which any of its n-grams is known decides, by their mean.  A document's
score is the sum over its words.

The model is fitted on a bounded sample of labelled documents and keeps every
word and n-gram of that sample.  It is sparse: an item has a score only for the
languages it was seen in, and each language one default per level for the rest.
Items are sorted 64-bit hashes, so a batch of texts is looked up at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, fresh, prepared

UNDETERMINED = "und"
#: Labelled documents that the model is fitted on, chosen by hash: of each language, and in all
#: (shared evenly by the languages).  They bound the model; nothing of the sample is left out.
SAMPLE_DOCS, SAMPLE_TOTAL = 2000, 40_000
LONGEST_GRAM = 5
SMOOTHING = 0.5
#: A letter and the marks that belong to it; numerals of any kind are no letters.
_LETTERS = regex.compile(r"(?:\p{L}\p{M}*+)++")
_ASCII_LETTERS = re.compile(r"[a-z]+")
#: Scores held at once while a batch is judged, documents times languages.
_CELLS = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def letters_of(text: str | None) -> list[str]:
    """Runs of letters with their marks, lower-cased."""
    if not text:
        return []
    lower = text.lower()
    return (_ASCII_LETTERS if lower.isascii() else _LETTERS).findall(lower)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashed:
    """Hashes of any windows of many words at once, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, words: Sequence[str]):
        marked = "".join(f"^{w}$" for w in words)
        codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        length = np.array([len(w) + 2 for w in words], np.int64)
        self.ends = np.cumsum(length)
        self.starts = self.ends - length
        power = np.cumprod(np.full(len(codes) + 1, _BASE))
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(codes + np.uint64(1)) * power[:-1])])
        self._back = np.cumprod(np.full(len(codes) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64))))

    def windows(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(np.uint64))

    def whole(self) -> np.ndarray:
        """One hash for each word, without its marks."""
        return self.windows(self.starts + 1, self.ends - 1)

    def grams(self, n: int, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``word, hash`` of all n-grams of the (chosen) words between their marks ``^`` and ``$``."""
        of = np.arange(len(self.starts)) if of is None else of
        count = np.maximum(self.ends[of] - self.starts[of] - n + 1, 0)
        word = np.repeat(of, count)
        within = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        start = self.starts[word] + within
        return word, self.windows(start, start + n)


@dataclass
class Level:
    """Items by sorted hash; item k has the languages and gains ``begins[k]`` to ``begins[k + 1]``."""

    items: np.ndarray
    begins: np.ndarray
    language: np.ndarray
    gain: np.ndarray
    default: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes, -1 where unknown."""
        if not len(self.items):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.items, hashes), len(self.items) - 1)
        return np.where(self.items[at] == hashes, at, -1)

    def entries(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``row, entry``: the entries of every place (row: its number among the places)."""
        count = self.begins[place + 1] - self.begins[place]
        row = np.repeat(np.arange(len(place)), count)
        return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.begins[place], count)


@dataclass
class Model:
    """Level 0 holds words, level n their n-grams."""

    languages: list[str]
    levels: list[Level]

    def _word_scores(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores of distinct words: level that decides (-1: none) and sparse ``word, language, gain``."""
        hashed = _Hashed(words)
        decides = np.full(len(words), -1)
        place = self.levels[0].find(hashed.whole())
        decides[place >= 0] = 0
        found = np.flatnonzero(place >= 0)
        row, entry = self.levels[0].entries(place[found])
        parts = [(found[row], self.levels[0].language[entry], self.levels[0].gain[entry])]
        for n in range(len(self.levels) - 1, 0, -1):
            left = np.flatnonzero(decides < 0)
            word, grams = hashed.grams(n, left)
            place = self.levels[n].find(grams)
            word, place = word[place >= 0], place[place >= 0]
            decides[word] = n
            share = 1 / np.bincount(word, minlength=len(words))[word]
            row, entry = self.levels[n].entries(place)
            parts.append((word[row], self.levels[n].language[entry], self.levels[n].gain[entry] * share[row]))
        word, language, gain = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(word, kind="stable")
        return decides, word[order], language[order], gain[order]

    def predict_batch(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """For every text the best language and its share of the probability; ``und`` and 0 without letters."""
        known: dict[str, int] = {}
        token: list[int] = []
        ends: list[int] = []
        for text in texts:
            token += [known.setdefault(w, len(known)) for w in letters_of(text)]
            ends.append(len(token))
        best, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not known or not self.languages:
            return best, score
        tokens, k = np.array(token, np.int64), len(self.languages)
        decides, word, language, gain = self._word_scores(list(known))
        begins = np.searchsorted(word, np.arange(len(known) + 1))
        defaults = np.array([np.zeros(k), *(level.default for level in self.levels)])
        bounds = np.array([0, *ends])
        step = max(1, _CELLS // k)
        for first in range(0, len(texts), step):
            last = min(first + step, len(texts))
            part = tokens[bounds[first]:bounds[last]]
            doc = np.repeat(np.arange(last - first), np.diff(bounds[first:last + 1]))
            levels = np.bincount(doc * len(defaults) + decides[part] + 1, minlength=(last - first) * len(defaults))
            total = levels.reshape(last - first, -1) @ defaults
            count = begins[part + 1] - begins[part]
            entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begins[part], count)
            total += np.bincount(np.repeat(doc, count) * k + language[entry], gain[entry], minlength=total.size).reshape(total.shape)
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            winner = np.argmax(odds, axis=1)
            share = odds[np.arange(len(odds)), winner] / odds.sum(axis=1)
            for d in np.flatnonzero(np.diff(bounds[first:last + 1])).tolist():
                best[first + d], score[first + d] = self.languages[winner[d]], share[d]
        return best, score

    def predict(self, text: str | None) -> tuple[str, float]:
        best, score = self.predict_batch([text])
        return best[0], float(score[0])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and language: how often each word and n-gram (by hash) stands there."""
    for batch in batches:
        frame = pd.DataFrame({"lang": batch.column(0).to_pylist(), "words": [letters_of(t) for t in batch.column(1).to_pylist()]})
        for lang, held in frame.groupby("lang", sort=False)["words"]:
            known: dict[str, int] = {}
            token = [known.setdefault(w, len(known)) for words in held for w in words]
            if not token:
                continue
            times, hashed = np.bincount(token), _Hashed(list(known))
            for n in range(LONGEST_GRAM + 1):
                word, hashes = hashed.grams(n) if n else (np.arange(len(known)), hashed.whole())
                item, place = np.unique(hashes, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(item), pa.string()), "level": pa.array(np.full(len(item), n, np.int32)),
                    "item": pa.array(item.astype(np.int64)),
                    "n": pa.array(np.bincount(place, times[word], minlength=len(item)).astype(np.int64))})


def _level(item: np.ndarray, language: np.ndarray, n: np.ndarray, languages: int) -> Level:
    """Log frequencies of the items, as gains over the default of each language."""
    order = np.lexsort([language, item])
    item, language, n = item[order], language[order], n[order]
    distinct, begins = np.unique(item, return_index=True)
    total = np.bincount(language, n, minlength=languages)
    default = np.log(SMOOTHING / (total + SMOOTHING * max(1, len(distinct))))
    return Level(distinct, np.append(begins, len(item)).astype(np.int64), language.astype(np.int32),
                 (np.log(n + SMOOTHING) - np.log(SMOOTHING)).astype(np.float32), default)


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS, sample_total: int = SAMPLE_TOTAL) -> Model:
    """A model from the rows where ``learn`` holds and the language is known.

    About ``sample_docs`` documents of each language are used, fewer if all
    languages together would have more than ``sample_total``, chosen by a hash of
    their id; all where there are fewer.  One row per language, and the counted
    words and n-grams of that sample, reach the driver.
    """
    prepared(docs.sparkSession)
    labelled = docs.where(learn & col(lang_col).isNotNull()).select(
        col(id_col).cast("string").alias("id"), col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    each = min(sample_docs, sample_total / max(1, len(languages)))
    shares = docs.sparkSession.createDataFrame([(k, each / n) for k, n in sizes.items()], "lang string, share double")
    chance = F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.withColumn("chance", chance).join(F.broadcast(shares), "lang").where(F.col("chance") < F.col("share"))
    counted = (sample.select("lang", "text").mapInArrow(_counted, "lang string, level int, item long, n long")
               .groupBy("lang", "level", "item").agg(F.sum("n").alias("n")).toArrow())
    number = {name: k for k, name in enumerate(languages)}
    names = counted["lang"].combine_chunks().dictionary_encode() if counted.num_rows else None
    language = np.zeros(0, np.int64)
    if names is not None:
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        language = np.array([number[x] for x in names.dictionary.to_pylist()])[names.indices.to_numpy()]
    level, item, n = (counted[c].to_numpy() for c in ("level", "item", "n"))
    item = item.astype(np.int64).view(np.uint64)
    return Model(languages, [_level(item[level == k], language[level == k], n[level == k], len(languages))
                             for k in range(LONGEST_GRAM + 1)])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: Sequence[Column] = ()) -> DataFrame:
    """``id_col``, the columns ``keep``, ``lang_pred`` and ``score`` (0 to 1): one row per input row.

    A null text, or one without letters, is ``und`` with score 0, and so is every
    text if the model was fitted on nothing.  Ties go to the first language by
    name.  Null ids and repeated rows stay.
    """
    held = prepared(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = held.value
        for texts in batches:
            best, score = fitted.predict_batch(texts.tolist())
            yield pd.DataFrame({"lang_pred": best, "score": score})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    judged = F.pandas_udf(run, "lang_pred string, score double")(col(text_col))
    out_id = fresh(["lang_pred", "score"], id_col)
    return docs.select(col(id_col).alias(out_id), *keep, judged.alias("_judged")).select(
        "*", "_judged.lang_pred", "_judged.score").drop("_judged")
