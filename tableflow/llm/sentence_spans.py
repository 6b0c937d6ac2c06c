"""Removing repeated passages by sliding spans of sentences.

A text is cut after the words that end in ``. ! ?``, at the end of every line with a
word, and after one word in ``CUT_EVERY``, chosen by its hash whatever the length of
the sentence: the pieces, called sentences here, are a few words long.  Whether a word
ends one depends on that word and its line end alone, so a passage is cut alike
wherever it stands, also in the middle of a sentence.  Every run of several
consecutive sentences is hashed and looked up in the whole corpus.  The first
occurrence of a run stays; sentences that any later one covers are removed, and so
removal can begin and end inside a grammatical sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, fresh, prepared, stored
from tableflow.llm.ngram_join import _bitmap, _in_bitmap, row_key

#: A run is the shortest of three sentences or more that has this many words.
SPAN_WORDS = 24
SPAN_SENTENCES = 3
#: One word in CUT_EVERY ends a sentence early.
CUT_EVERY = 4

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _words(data: bytes) -> tuple[list[bytes], np.ndarray]:
    """Lower-cased words, and for each whether a line ends after it."""
    words, last = [], []
    for line in data.translate(_LOWER).split(b"\n"):
        held = line.split()
        if held:
            words += held
            last.append(len(words) - 1)
    ends = np.zeros(len(words), bool)
    ends[last] = True
    return words, ends


def sentence_ends(words: list[bytes], line_ends: np.ndarray, hashes: np.ndarray) -> list[int]:
    """The last word of every sentence."""
    mark = np.fromiter((w[-1] for w in words), np.uint8, len(words))
    stop = line_ends | (mark == 46) | (mark == 33) | (mark == 63) | (hashes % np.uint64(CUT_EVERY) == 0)
    stop[-1:] = True
    return np.flatnonzero(stop).tolist()


def runs(text: str | None) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hashes of all runs, the first and last sentence of each (n x 2), and the last word of each sentence."""
    words, line_ends = _words((text or "").encode("utf-8", "surrogatepass"))
    none = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
    if not words:
        return *none, []
    n = len(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    ends = sentence_ends(words, line_ends, hashes)
    last_words = np.array(ends)
    starts = np.concatenate([np.zeros(1, np.int64), last_words[:-1] + 1])
    last = np.maximum(np.searchsorted(last_words, starts + SPAN_WORDS - 1), np.arange(len(ends)) + SPAN_SENTENCES - 1)
    last = last[last < len(ends)]
    if not len(last):
        return *none, ends
    spans = np.column_stack([np.arange(len(last)), last])
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _MUL)]))
    inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE)]))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n])])
    first, past = starts[:len(last)], last_words[last] + 1
    h = (total[past] - total[first]) * inverse[first] + (past - first).astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32)), spans, ends


def _run_table(texts: DataFrame, bitmap: np.ndarray | None) -> DataFrame:
    """``run`` (32 bits) for all runs, or ``run64, doc_id, rowkey, first, last`` for those in the bitmap.

    With a bitmap, every text also has a row without ``run64`` and ``last`` whose ``first``
    counts its sentences, and one without ``run64`` for each run that repeats an earlier one of its own.

    A run that a text repeats is listed where it first stands: the others are
    later ones whatever the corpus holds.
    """
    held = texts.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None
    kind = dict(texts.dtypes)["doc_id"]

    def short(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(short(runs(t.as_py())[0])) for t in batch.column("text")]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["run"])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, run, span, looked_up = [], [np.zeros(0, np.uint64)], [np.zeros((0, 2), np.int64)], [np.zeros(0, bool)]
            for t in batch.column("text"):
                h, spans, ends = runs(t.as_py())
                first = np.unique(h, return_index=True)[1]
                again = np.ones(len(h), bool)
                again[first] = False
                kept, own = first[_in_bitmap(held.value, short(h[first]))], np.flatnonzero(again)
                run += [h[kept], np.zeros(1 + len(own), np.uint64)]
                span += [spans[kept], np.array([[len(ends), -1]]), spans[own]]
                looked_up += [np.ones(len(kept), bool), np.zeros(1 + len(own), bool)]
                count.append(len(kept) + 1 + len(own))
            at = pa.array(np.repeat(np.arange(len(count)), count), pa.int64())
            span, off = np.concatenate(span).astype(np.int32), ~np.concatenate(looked_up)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(run).view(np.int64), mask=off), batch.column("doc_id").take(at), batch.column("rowkey").take(at),
                 pa.array(span[:, 0]), pa.array(span[:, 1], mask=span[:, 1] < 0)], ["run64", "doc_id", "rowkey", "first", "last"])

    if held is None:
        return texts.select("text").mapInArrow(all_runs, "run int")
    return texts.mapInArrow(chosen, f"run64 long, doc_id {kind}, rowkey long, first int, last int")


def cut_text(text: str, gone: set[int]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the sentences ``gone``, and the code-point spans taken out.

    A sentence reaches up to the next one's first word.
    """
    data = text.encode("utf-8", "surrogatepass")
    _, _, ends = runs(text)
    begins = [m.start() for m in _WORD.finditer(data)]
    starts = [0, *(begins[e + 1] for e in ends[:-1])]
    out, spans, at = [], [], 0
    for k, (s, e) in enumerate(zip(starts, [*starts[1:], len(data)])):
        part = data[s:e]
        n = len(part.decode("utf-8", "surrogatepass"))
        if k not in gone:
            out.append(part)
        elif spans and spans[-1][1] == at:
            spans[-1] = (spans[-1][0], at + n)
        else:
            spans.append((at, at + n))
        at += n
    return b"".join(out).decode("utf-8", "surrogatepass"), spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text, n_sentences, n_removed, removed``: one row per input row.

    ``removed`` lists the code-point spans taken out of the input text.  The first
    occurrence of a run is that of the smallest id (null last), then row key, then
    place.  Rows alike in id and text are one document listed twice and get the same
    result: copies that differ in neither stay, all of them.  A null text stays null
    with no sentences; empty and short texts have no runs and stay; an empty table
    gives no rows.  Other columns are not carried.
    """
    prepared(docs.sparkSession)
    texts = docs.select(col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rowkey"), col(text_col).alias("text"))
    counted = stored(_run_table(texts, None).groupBy("run").agg(F.count("*").alias("c")).where("c > 1").select("run"))
    places = stored(_run_table(texts, _bitmap(counted, "run")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rowkey")
    firsts = stored(places.where("run64 IS NOT NULL").groupBy("run64").agg(F.min(order).alias("at"), F.max(order).alias("to")).where("at <> to")
                    .select("run64", F.col("at.rowkey").alias("first_key")))
    # a run of very many documents is one key: both sides are dealt anew, so it can be split
    run, none = F.struct("first", "last").alias("run"), F.lit(None).cast("int").alias("n")
    later = places.join(firsts, "run64").where(F.col("rowkey") != F.col("first_key")).select("rowkey", none, run)
    own = places.where("run64 IS NULL").select("rowkey", F.when(F.col("last").isNull(), F.col("first")).alias("n"),
                                               F.when(F.col("last").isNotNull(), run).alias("run"))
    # rows alike in id and text repeat the same runs: a set
    found = later.union(own).groupBy(F.col("rowkey").alias("found_key")).agg(
        F.max("n").alias("n"), F.collect_set("run").alias("gone"))
    joined = texts.join(found, F.col("rowkey") == F.col("found_key"), "left").select("doc_id", "text", "n", "gone")
    out_id = fresh(["text", "n_sentences", "n_removed", "removed"], id_col)
    kind = dict(texts.dtypes)["doc_id"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, removed, spans = [], [], []
            for held_text, found in zip(batch.column("text"), batch.column("gone")):
                text = held_text.as_py()
                gone = {k for r in found.as_py() or () for k in range(r["first"], r["last"] + 1)}
                removed.append(len(gone))
                kept, taken = cut_text(text, gone) if gone else (text, [])  # only texts that lose something are cut again
                new.append(kept)
                spans.append([{"start": s, "end": e} for s, e in taken])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(new, pa.string()), batch.column("n").cast(pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "text", "n_sentences", "n_removed", "removed"])

    out = joined.mapInArrow(apply, f"doc_id {kind}, text string, n_sentences long, n_removed long, "
                            "removed array<struct<start:long,end:long>>")
    return out.withColumnRenamed("doc_id", out_id)
