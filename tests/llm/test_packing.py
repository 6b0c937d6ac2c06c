import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tableflow.llm import packing as P
from tests.llm.helpers import documents, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(PATH)


def _expected(slow, text):
    return [*(slow.encode(text, add_special_tokens=False).ids if text else []), 2]


def _check(rows, expected, capacity=P.Capacity()):
    """Every document comes back exactly, every sequence holds and is gapless."""
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(parts) <= capacity.docs
        assert sum(n * n for _, n in parts) <= capacity.cost
    got = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for i, ids in expected:
        first = len(ids) % capacity.tokens or capacity.tokens
        cuts = [0, *range(first, len(ids), capacity.tokens), len(ids)]
        want += [(str(i), p, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes()))
                 for p, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    assert got == sorted(want)
    return len(by_seq)


def test_round_trip_and_few_sequences(spark, slow):
    df = documents(spark)
    expected = [(r.doc_id, _expected(slow, r.text)) for r in df.collect()]
    n = _check(P.pack_documents(df, PATH).collect(), expected)
    assert n <= 1.01 * sum(len(x) for _, x in expected) / 1024 + 1


def test_odd_rows(spark, slow):
    df = odd_documents(spark)
    expected = [(r.doc_id, _expected(slow, r.text)) for r in df.collect()]
    _check(P.pack_documents(df, PATH).collect(), expected)
    assert P.pack_documents(df.limit(0), PATH).count() == 0


def test_ids_are_carried_into_sequences(spark, slow):
    df = documents(spark).limit(30)
    packed = P.pack_documents(df, PATH, with_ids=True).collect()
    texts = {r.doc_id: _expected(slow, r.text) for r in df.collect()}
    held = spark.createDataFrame(packed)
    seqs = {r.sequence_id: r.input_ids for r in P.sequences(held).collect()}
    for r in packed:
        assert seqs[r.sequence_id][r.offset:r.offset + r.length] == texts[r.doc_id][r.start:r.start + r.length]


def test_encoder_equals_the_reference_tokenizer(slow):
    fast, rng = P.Encoder(PATH), random.Random(7)
    assert fast.fast is not None
    texts = ["", "<|endoftext|>", "a <|endoftext|> b", "日本語 text", "x\u2003y", "tab\there", "\x85", "a\x1cb", "'s 't don't"]
    texts += ["".join(rng.choice("ab'sT 1\n\té  ßx!.,日\r\u00a0") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for t in texts:
        assert list(fast(t)) == slow.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("select", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [P.Capacity(100, 100, 10_000), P.Capacity(100, 3, 10_000), P.Capacity(100, 50, 4000)])
def test_capacities_hold_and_bind(select, capacity):
    rng = random.Random(3)
    lengths = np.array(sorted((rng.randint(1, 60) for _ in range(400)), reverse=True))
    bins, offsets = P.best_fit(lengths, capacity, select)
    for b in set(bins.tolist()):
        held = lengths[bins == b]
        assert held.sum() <= capacity.tokens and len(held) <= capacity.docs and (held ** 2).sum() <= capacity.cost
        assert sorted(offsets[bins == b]) == [0, *np.cumsum(held)[:-1]]


def test_best_fit_takes_the_tightest_sequence():
    bins, _ = P.best_fit(np.array([70, 60, 40, 30]), P.Capacity(100, 100, 10 ** 9))
    assert bins.tolist() == [0, 1, 1, 0]
    with pytest.raises(ValueError):
        P.best_fit(np.array([101]), P.Capacity(100, 10, 10 ** 9))


def test_pools_of_any_size_pack_everything(spark, slow):
    df = documents(spark)
    cut = P.pieces(df, PATH)
    expected = [(r.doc_id, _expected(slow, r.text)) for r in df.collect()]
    _check(P.pack(cut, pool_pieces=16).collect(), expected)
