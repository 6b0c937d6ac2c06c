"""Packing documents into sequences by vector best-fit.

Documents become token pieces (only longer ones are cut); pieces are dealt into
pools of a bounded number of rows, and each pool is packed on its own, longest
piece first, into the open sequence that fits best in tokens, documents and
attention cost together.  Pools are formed by hashing a piece's place in the
input, so they are equal in size whatever the documents look like.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, prepared, stored

MAX_TOKENS = 1024
END_ID = 2
#: Pieces per pool: a pool leaves about one sequence partly filled.
POOL_PIECES = 8192
#: Splits text before the merges of a byte-level BPE with this pattern (public, fixed).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Text of other characters goes to ``tokenizers``: their classes may differ between Unicode versions.
_PLAIN = re.compile(r"[\t\n\r -~\xa1-\xac\xae-ɏ]*+\Z")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most; cost is the sum of squared piece lengths."""

    tokens: int = MAX_TOKENS
    docs: int = MAX_TOKENS
    cost: int = MAX_TOKENS * MAX_TOKENS


class Encoder:
    """Token ids as ``tokenizers`` gives them for the file at ``path``.

    Where the file is a plain byte-level BPE whose ids follow its merge order, the
    same merges run in ``tiktoken``, several times faster; special strings, unusual
    characters and every other kind of file take ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.fast, self.special = None, ()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = tuple(t["content"] for t in spec.get("added_tokens") or ())
        ranks = _byte_ranks(spec)
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and _PLAIN.match(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes to id, if the file is a byte-level BPE with ids in merge order, else None."""
    model, pre = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and not model.get("ignore_merges"))
    if not plain:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens") or ()}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if len(pairs) + 256 != len(vocab) or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut_points(n: int, most: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens: only the first may be shorter than ``most``."""
    first = n % most or most
    return [(0, first), *((s, most) for s in range(first, n, most))]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, lot, place`` (and ``ids``): the token pieces.

    ``ids_crc32`` is over little-endian unsigned 32-bit ids.  ``lot, place`` number
    the pieces by input partition.  A null text is empty: its document is the end
    id alone.  Null ids and repeated rows give pieces like any other row.
    """
    prepared(docs.sparkSession)
    source = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, lot, place = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows, piece, start, length, crc, held = [], [], [], [], [], []
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                tokens = np.append(encode(text) if text else np.zeros(0, np.uint32), end_id).astype("<u4")
                for p, (s, n) in enumerate(cut_points(len(tokens), max_tokens)):
                    part = tokens[s:s + n]
                    rows.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        held.append(part.astype(np.int32))
            arrays = [ids.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([lot] * len(rows), pa.int64()),
                      pa.array(range(place, place + len(rows)), pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "lot", "place"]
            if with_ids:
                arrays.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            place += len(rows)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return source.mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, lot long, "
                             "place long" + ", ids array<int>" * with_ids)


def best_fit(lengths: np.ndarray, capacity: Capacity, select: str = "norm",
             weights: tuple[float, float, float] = (1.0, 0.05, 0.05)) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece, pieces in the given order.

    A piece may enter a sequence whose residual tokens, documents and cost all
    suffice.  Of those, ``norm`` takes the one left with the smallest weighted
    norm of residuals, ``dot`` the one whose residual has the largest weighted
    dot product with the piece, relative to its norm; ties go to the lower slot.
    """
    full = np.array([capacity.tokens, capacity.docs, capacity.cost], float)
    n, scale = len(lengths), np.asarray(weights, float) / full ** 2
    left = np.empty((3, max(n, 1)))
    bins, offsets, owner = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(max(n, 1), np.int64)
    smallest = float(lengths.min()) if n else 0.0
    least = np.array([smallest, 1.0, smallest ** 2])
    open_bins = made = 0
    for i in range(n):
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2])
        if (need > full).any():
            raise ValueError(f"a piece of {lengths[i]} tokens exceeds the capacity {capacity}")
        at = -1
        if open_bins:
            room = left[:, :open_bins]
            fits = (room >= need[:, None]).all(axis=0)
            if fits.any():
                if select == "norm":
                    score = -(scale @ (room - need[:, None]) ** 2)
                else:
                    score = (scale * need) @ room / np.sqrt(scale @ room ** 2 + 1e-300)
                at = int(np.argmax(np.where(fits, score, -np.inf)))
        if at < 0:
            at, open_bins = open_bins, open_bins + 1
            left[:, at] = full
            owner[at] = made
            made += 1
        bins[i], offsets[i] = owner[at], full[0] - left[0, at]
        left[:, at] -= need
        if (left[:, at] < least).any():  # nothing fits any more: the last open one takes its slot
            open_bins -= 1
            left[:, at], owner[at] = left[:, open_bins], owner[open_bins]
    return bins, offsets


def pack(cut: DataFrame, capacity: Capacity = Capacity(), select: str = "norm",
         pool_pieces: int = POOL_PIECES) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset`` in place of ``lot`` and ``place``.

    ``cut`` is written to the checkpoint folder first, so its rows are counted and
    packed without being tokenized twice.  Equal lengths are taken in input order.
    """
    cut = stored(cut)
    pools = max(1, -(-cut.count() // pool_pieces))
    kept = [c for c in cut.columns if c not in ("lot", "place")]
    kinds = dict(cut.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", sequence_id long, offset long"

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("lot", "ascending"), ("place", "ascending")])
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity, select)
        return (rows.select(kept).append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins))
                .append_column("offset", pa.array(offsets)))

    pool = F.pmod(F.xxhash64("lot", "place"), F.lit(pools)).cast("long")
    return cut.withColumn("pool", pool).groupBy("pool").applyInArrow(fill, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: Capacity = Capacity(), id_col: str = "doc_id",
                   text_col: str = "text", end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece.

    Nulls, empty texts and repeated rows: see :func:`pieces`.  An empty table
    gives an empty result; other columns of ``docs`` are not carried.
    """
    return pack(pieces(docs, tokenizer_path, id_col, text_col, capacity.tokens, end_id, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, input_ids``: the ids of each sequence, for pieces packed ``with_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.getField("ids"))).alias("input_ids"))
