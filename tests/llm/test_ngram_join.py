import random

import numpy as np
import pytest

from tableflow.llm import ngram_join as N
from tests.llm.helpers import documents, jaccard_classes, odd_documents, shingles


def _compare(spark, texts, k, percent):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, sizes = jaccard_classes(texts, k, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.jaccard_classes(df, k, percent).collect()}
    assert got == {i: (sizes[i], want[i]) for i in range(len(texts))}


def _variants(seed, n=120):
    """Copies with edits, chains of edits, prefixes, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + [f"U{k}" for k in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 90]))] for _ in range(6)]
    out = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1])
        out.append(" ".join(w).swapcase() if rng.random() < 0.2 else "\n".join(w))
        if rng.random() < 0.3:
            base.append(w)
    return out + ["", None, " \t", "one", "ONE", "one two", "one two three", "One Two Three"]


@pytest.mark.parametrize("seed,k,percent", [(0, 4, 85), (1, 5, 80), (2, 4, 85)])
@pytest.mark.parametrize("short,block", [(64, 256), (1, 4)])
def test_matches_all_pairs(spark, monkeypatch, seed, k, percent, short, block):
    """Also with nearly all posting lists taking the block path."""
    monkeypatch.setattr(N, "SHORT_LIST", short)
    monkeypatch.setattr(N, "BLOCK_NODES", block)
    _compare(spark, _variants(seed), k, percent)


def test_whole_table(spark):
    _compare(spark, [r.text for r in documents(spark).orderBy("doc_id").collect()], 4, 85)


def test_threshold_is_exact(spark):
    """Overlap 17 of 20 links at 85, 16 of 19 does not."""
    a = [f"t{k}" for k in range(21)]
    _compare(spark, [" ".join(a), " ".join(a[:-1] + ["x"]), " ".join(a[:18]), " ".join(a[:20]), " ".join(a[3:])], 4, 85)


def test_group_of_equal_texts_and_common_lines(spark):
    line = "this very common line stands in all of the texts here"
    _compare(spark, [line] * 150 + [f"{line} {k} " + " ".join(f"{k}-{j}" for j in range(30)) for k in range(100)], 4, 85)


def test_shingles_follow_words():
    for text in ["a b c d e", "a b", "A  b\tC\x0bd", "é È é È é", "x " * 50]:
        words = N.lower_words_of(text)
        assert len(N.shingle_hashes(words, 4)) == len(shingles(text, 4))
    assert N.shingle_hashes([b"a", b"b"], 4)[0] != N.shingle_hashes([b"b", b"a"], 4)[0]
    assert len(N.shingle_hashes([], 4)) == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 100, 1001])
@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_prefix_is_just_long_enough(n, percent):
    least = -(-percent * n // 100)  # overlap of the smallest partner
    assert N.prefix_length(n, percent) == n - least + 1


def test_block_overlaps_match_sets(monkeypatch):
    monkeypatch.setattr(N, "BLOCK_NGRAMS", 7)
    rng = np.random.default_rng(1)
    a = [np.unique(rng.integers(0, 60, 20).astype(np.uint64)) for _ in range(9)]
    b = [np.unique(rng.integers(0, 60, 25).astype(np.uint64)) for _ in range(5)]
    assert N.block_overlaps(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]


def _sketch_of(texts, size):
    sketch = np.zeros(1 << 12, np.int32)
    for t in texts:
        np.add.at(sketch, (N.shingle_hashes(N.lower_words_of(t), size) & np.uint64(len(sketch) - 1)).astype(np.int64), 1)
    return sketch


def test_fragments_cut_one_global_order_evenly():
    texts = [t for t in _variants(3, 400) if t]
    sketch = _sketch_of(texts, 4)
    cuts = N.pivots(sketch, 8)
    assert (np.diff(cuts.astype(float)) >= 0).all()
    held = np.zeros(8)
    for t in texts:
        tokens = N.shingle_hashes(N.lower_words_of(t), 4)
        parts = N.fragments_of(tokens, sketch, cuts)
        assert np.array_equal(np.sort(np.concatenate(parts)), tokens) and all((np.diff(p) > 0).all() for p in parts)
        held += [len(p) for p in parts]
        keys = [N._order_key(p, sketch) for p in parts]
        for k, cut in enumerate(cuts):  # whatever the document, an n-gram has its one fragment
            assert all((keys[j] < cut).all() for j in range(k + 1)) and all((keys[j] >= cut).all() for j in range(k + 1, 8))
    assert held.max() < 2 * held.sum() / 8 and held.min() > 0.3 * held.sum() / 8
    assert len(N.pivots(np.zeros(4, np.int32), 8)) == 7


def test_partial_counts_of_the_fragments_add_up_across_partitions(spark):
    texts = [t for t in _variants(5, 60) if t and len(t.split()) > 7]
    sets = {k: N.shingle_hashes(N.lower_words_of(t), 4) for k, t in enumerate(texts)}
    sketch = _sketch_of(texts, 4)
    cuts = N.pivots(sketch, N.FRAGMENTS)
    tokens = spark.createDataFrame(
        [(k, f, len(s), bytearray(p.tobytes())) for k, s in sets.items() for f, p in enumerate(N.fragments_of(s, sketch, cuts))],
        "fp long, fragment int, n long, tokens binary").repartition(7)
    half = len(sets) // 2
    units = spark.createDataFrame([(1, 0, 0, 0, 1, int(k >= half), k) for k in sets] + [(2, 0, 0, 0, 0, 0, k) for k in sets],
                                  "root long, low int, i int, high int, j int, side int, node long")
    partial = N._partial_counts(units, tokens).collect()
    assert len(partial) == 2 * N.FRAGMENTS and len({r.counts for r in partial}) > N.FRAGMENTS
    for root in (1, 2):
        rows = [r for r in partial if r.root == root]
        assert len({(tuple(r.left), tuple(r.right)) for r in rows}) == 1
        total = sum(np.frombuffer(N.zlib.decompress(r.counts), "<i4") for r in rows).reshape(len(rows[0].left), -1)
        want = [[len(np.intersect1d(sets[a], sets[b])) for b in rows[0].right] for a in rows[0].left]
        assert total.tolist() == want


def test_long_texts_take_blocks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(N, "NODE_NGRAMS", 20)
    monkeypatch.setattr(N, "BLOCK_NODES", 6)
    _compare(spark, _variants(9), 4, 85)


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = N.jaccard_classes(df, 4, 85).collect()
    assert len(rows) == df.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == [(3, 1)] and sorted(by[7]) == [(1, 7), (3, 1), (3, 1)] and by[5] == by[6]
    assert sorted(by[None], key=str) == [(0, None), (3, 1)] and by[2] == [(0, 2)] and by[4] == [(0, 4)]
    assert N.jaccard_classes(df.limit(0), 4, 85).count() == 0


def test_keep_one_of_each_class(spark):
    df = odd_documents(spark)
    kept = N.keep_one(df, 4, 85)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, None, 5, 7, 8, 9]))
    assert N.keep_one(df.limit(0)).count() == 0
