import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from tableflow.llm import word_bpe as W
from tests.llm.helpers import SF_SMALL, documents, odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return W.WordBPE(PATH)


def encoded(bpe, texts):
    ids, ends = bpe.encode_batch(texts)
    return [ids[a:b].tolist() for a, b in zip([0, *ends], ends)]


def check(bpe, library, texts):
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = encoded(bpe, texts)
    assert got == want
    held = W.decoded(pa.array(got, pa.list_(pa.int32())), pa.array(W.shown_tokens(bpe.path)))
    assert held.to_pylist() == [library.decode(i, skip_special_tokens=False) for i in want]


def test_documents_encode_and_decode_as_in_the_library(spark, library):
    df = documents(spark)
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = W.decode(W.encode(df, PATH), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_digests_of_the_query(spark, library):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    for r in E.queries()["op13_word_bpe"](spark, SF_SMALL).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_odd_rows(spark, library):
    df = odd_documents(spark)
    got = sorted((str(r.doc_id), r.ids) for r in W.encode(df, PATH).collect())
    assert got == sorted((str(r.doc_id), library.encode(r.text or "", add_special_tokens=False).ids) for r in df.collect())
    assert W.decode(W.encode(df.limit(0), PATH), PATH).count() == 0
    assert W.decode(spark.createDataFrame([(None,), ([],), ([518, 0],)], "ids array<int>"), PATH).toPandas()["decoded"].tolist() == [
        None, "", library.decode([518, 0])]


@pytest.mark.parametrize("alphabet", ["abehinrst", "ab", "a", "aehinst'!.,0 ", "éßa ñ\t\r\n", "a.|<>/w", "日本 Σσς İı ́ae\x85 \x1c\0🙂‍٣Ⅷ"])
def test_random_texts(bpe, library, alphabet):
    rng = random.Random(len(alphabet))
    check(bpe, library, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(1500)])


def test_special_strings_long_words_and_odd_spaces(bpe, library):
    rng = random.Random(2)
    check(bpe, library, ["", None, " ", "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|startoftext|>", "<|ENDOFTEXT|> <|x|>", "</w> a</w>",
                         "Don't I'll 'S'T we'RE", "a" * 5000, "".join(rng.choice("aehinst") for _ in range(20_000)), "ÀÉ\xa0Ï",
                         "é<|endoftext|>́e"])


def test_verification_is_exact_for_pairs(bpe, library):
    """A pair stands exactly if merging its string gives the pair back."""
    rng = random.Random(4)
    tokens = list(bpe._known.items())
    pairs = [(x, y) for x, y in ((rng.choice(tokens), rng.choice(tokens)) for _ in range(6000)) if not x[0].endswith("\n")]
    fits = bpe.compatible(np.array([x[1] for x, _ in pairs]), np.array([y[1] for _, y in pairs]))
    assert 0 < fits.sum() < len(pairs)
    for (x, y), ok in zip(pairs, fits.tolist()):
        if y[0].endswith("\n"):
            assert ok == (bpe.merge([x[0] + y[0]]) == [[x[1], y[1]]])


def test_only_failing_words_are_merged(bpe, monkeypatch):
    asked, merge = [], bpe.merge
    monkeypatch.setattr(bpe, "merge", lambda w: asked.extend(w) or merge(w))
    words = ["the", "house", "of", "singing", "birds", "xqzzhinst", "antheresting"]
    ids, length = bpe.words(words)
    assert [part.tolist() for part in np.split(ids, np.cumsum(length)[:-1])] == merge([w + "\n" for w in words])

    def guess(w):
        out = []
        bpe.guess(w, out)
        return out

    assert len(asked) < len(words)
    assert [w[:-1] for w in asked] == [w for w in words if [guess(w + "\n")] != merge([w + "\n"])]


def test_merging_at_once_and_one_by_one_agree(bpe):
    rng = random.Random(6)
    words = ["".join(rng.choice("aehinst") for _ in range(rng.randint(1, 40))) + "\n" for _ in range(800)] + ["a" * n + "\n" for n in range(1, 34)]
    assert bpe.merge(words) == [bpe._merge_long(w) for w in words]
    assert bpe.merge([]) == []


def test_slices_of_a_batch_do_not_matter(bpe, monkeypatch):
    texts = ["some words", None, "", "<|endoftext|> more", "words " * 40] * 5
    whole = encoded(bpe, texts)
    monkeypatch.setattr(W, "SLICE_CHARS", 30)
    assert encoded(bpe, texts) == whole and encoded(bpe, []) == []


def test_memory_is_bounded(bpe, library, monkeypatch):
    monkeypatch.setattr(W, "REMEMBERED", 5)
    for k in range(4):
        check(bpe, library, [f"some words {k} and more{k} of them" * 3])
        assert len(bpe._memory) < 40


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="not a word-level"):
        W.WordBPE(public_tokenizers.path("byte_bpe_50k.json"))


def test_tokens_that_merges_never_give_are_not_guessed(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    alphabet = {t: i for t, i in spec["model"]["vocab"].items() if i < 512}
    merges = [["b", "c"], ["a", "b"], ["ab", "c"], ["abc", "d</w>"], ["ab", "c</w>"]]  # b takes c first: 'abc' inside a word is a, bc
    vocab = {**alphabet, "bc": 512, "ab": 513, "abc": 514, "abcd</w>": 515, "abc</w>": 516}
    spec["model"] |= {"vocab": vocab, "merges": merges}
    spec["added_tokens"] = []
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    small, lib = W.WordBPE(str(path)), Tokenizer.from_file(str(path))
    assert "abc" not in small._known and "abcd\n" not in small._known and "abc\n" in small._known
    check(small, lib, ["abc", "abca", "abcd", "abcd abcdd dabc", "aabcabc abab bcabc", "abcabcabc", "cab bca", "aaab"])
