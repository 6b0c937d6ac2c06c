"""Encoding and decoding with a word-level byte-pair vocabulary: speculate and verify.

The tokens of a word are first guessed, longest match first.  The guess is what
the merges would give exactly if no pair of neighbours would have been merged
across its border while both were growing.  That is checked for all distinct
pairs of a batch at once, on arrays: the two tokens are taken apart from the
last merge backwards, and each pair of symbols that met at the border is looked
up among the merges.  Words with a pair that fails are merged exactly, one by one.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, prepared

#: The pieces a text is cut into before merging (fixed by the vocabulary; checked on loading).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The normalisation that the vocabulary asks for (fixed; checked on loading).
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Texts of these characters alone are lower-cased and cut here: their classes are the same in every
#: Unicode version.  Other texts are normalised and cut by the installed library's own tables.
_PLAIN = regex.compile(r"[\t\n\r -~\xa1-\xac\xae-įı-ɏ]*+\Z")
#: Stands for the end of a word inside token strings; no byte is shown as this character.
_END = "\n"
_PREFIX = 3
#: What chunks that are no plain run begin with: special strings, and text for the library to cut.
_MARKS = "\0\n"
_NONE = np.int64(1) << 40
#: Chunks, and ids of theirs, that a worker remembers from batch to batch; beyond, all are forgotten.
REMEMBERED, REMEMBERED_IDS = 3 << 17, 3 << 20
#: Characters of texts that are cut into chunks at once.
SLICE_CHARS = 1 << 20
#: Failing words of up to so many symbols are merged in one array each; longer ones one by one, with a heap.
WIDTHS = (8, 16, 32)


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies (a public rule)."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBPE:
    """The vocabulary at ``path``: byte-level pieces with word ends, merged in order of rank."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix")
        self._check(spec, suffix)
        vocab: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = {a + b for a, b in pairs}
        size = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens") or ())]) + 1
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self._split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        # a line feed begins a chunk
        self._split_pieces = regex.compile("\\n|" + PIECES).findall
        self._table = {k: c for k, c in enumerate(byte_characters())}

        # a symbol's own string, with _END for a word's end; symbols not made by merges are the alphabet
        strings = {i: t[:-len(suffix)] + _END if t != suffix and t.endswith(suffix) else t for t, i in vocab.items() if t not in made}
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            i, x, y = vocab[a + b], vocab[a], vocab[b]
            if self.rank[i] >= 0 or max(self.rank[x], self.rank[y]) >= rank or x not in strings or y not in strings:
                raise ValueError("merges out of order")
            self.rank[i], self.left[i], self.right[i] = rank, x, y
            strings[i] = strings[x] + strings[y]
            merged[x, y] = (rank, i)
        self._merges = merged
        keys = np.array([x * size + y for x, y in merged], np.int64)
        order = np.argsort(keys)
        self._size, self._keys = size, np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.append(np.array([r for r, _ in merged.values()], np.int64)[order], _NONE)
        self._made = np.append(np.array([i for _, i in merged.values()], np.int64)[order], -1)
        self._alphabet = {s: i for i, s in strings.items() if self.rank[i] < 0}
        self._known = self._proper(strings, merged)
        #: The longest known token by its first characters: no longer one needs a look.
        self._reach: dict[str, int] = {}
        for token in self._known:
            for n in range(1, _PREFIX + 1):
                self._reach[token[:n]] = max(self._reach.get(token[:n], 0), len(token))
        self._code = {last: np.full(1 << 9, -1, np.int64) for last in (False, True)}
        for symbol, i in self._alphabet.items():
            self._code[symbol.endswith(_END)][ord(symbol[0])] = i
        self._forget()

    @staticmethod
    def _check(spec: dict, suffix: str | None) -> None:
        model, pre, norm = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        parts = pre.get("pretokenizers") or [{}, {}]
        asked = (model.get("type") == "BPE" and suffix and not model.get("dropout") and not model.get("continuing_subword_prefix")
                 and not model.get("ignore_merges") and not model.get("byte_fallback") and spec.get("decoder") is None
                 and spec.get("post_processor") is None
                 and [n.get("type") for n in norm.get("normalizers") or ()] == NORMALIZERS
                 and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
                 and parts[0].get("pattern") == {"Regex": PIECES} and parts[0].get("invert") and parts[0].get("behavior") == "Removed"
                 and not parts[1].get("add_prefix_space") and not parts[1].get("use_regex")
                 and not any(t[f] for t in spec.get("added_tokens") or () for f in ("single_word", "lstrip", "rstrip", "normalized")))
        if not asked:
            raise ValueError("not a word-level byte-pair vocabulary of the kind that this operator reads")

    def _proper(self, strings: dict[int, str], merged: dict) -> dict[str, int]:
        """Tokens that the merges give for their own string: only these are guessed."""
        ids = np.array([i for _, i in merged.values()], np.int64)
        stands = self.compatible(self.left[ids], self.right[ids], self.rank[ids])
        good = {i: True for i in strings if self.rank[i] < 0}
        for i, ok in zip(ids.tolist(), stands.tolist()):  # in order of rank: parts come first
            good[i] = ok and good[int(self.left[i])] and good[int(self.right[i])]
        return {strings[i]: i for i, ok in good.items() if ok}

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether the merges leave the border between tokens ``a`` and ``b`` alone, for all pairs at once.

        Backwards in time: a merge of rank r at the border happens if it is due
        before its left symbol is used up (r below that merge's rank) and not
        after its right symbol is (r at most that rank, as the border lies to the
        left).  ``limit``: the rank at which the whole pair is merged itself.
        """
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a = np.full(len(a), _NONE) if limit is None else np.array(limit, np.int64)
        ends_b = ends_a.copy()
        fits, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            rank, _ = self._pair(x, y)
            clash = (rank < ends_a[open_]) & (rank <= ends_b[open_])
            if limit is not None:  # the pair's own merge is no clash
                clash &= rank < np.asarray(limit)[open_]
            fits[open_[clash]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_a, undo_b = rx > ry, (ry >= rx) & (ry >= 0)
            i, j = open_[undo_a], open_[undo_b]
            ends_a[i], a[i] = rx[undo_a], self.right[x[undo_a]]
            ends_b[j], b[j] = ry[undo_b], self.left[y[undo_b]]
            open_ = open_[(undo_a | undo_b) & ~clash]
        return fits

    def guess(self, word: str, out: list[int]) -> int:
        """Longest known tokens from the left, added to ``out``; their number.  ``word`` ends in ``_END``."""
        known, reach, at, n, held = self._known, self._reach, 0, len(word), len(out)
        while at < n:
            end = min(n, at + reach.get(word[at:at + _PREFIX], _PREFIX - 1))
            # a single character is always known; the last one is not parted from the end of the word
            while end == n - 1 or (token := known.get(word[at:end])) is None:
                end -= 1
            out.append(token)
            at = end
        return len(out) - held

    def _forget(self) -> None:
        #: Chunk to its place; place k has the ids ``_pool[_begins[k]:_begins[k + 1]]``.
        self._memory = _Numbers()
        self._pool, self._begins = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def merge(self, words: Sequence[str]) -> list[list[int]]:
        """The tokens of words by their merges, lowest rank first, leftmost among equals; all words at once."""
        out: list[list[int]] = [[] for _ in words]
        width = np.searchsorted(WIDTHS, [len(w) - 1 for w in words])
        for k, most in enumerate(WIDTHS):
            held = np.flatnonzero(width == k)
            for i, ids in zip(held.tolist(), self._merge_array([words[i] for i in held.tolist()], most)):
                out[i] = ids
        for i in np.flatnonzero(width == len(WIDTHS)).tolist():
            out[i] = self._merge_long(words[i])
        return out

    def _merge_array(self, words: Sequence[str], width: int) -> list[list[int]]:
        """A row per word; every round makes the best merge of each word that has one."""
        if not words:
            return []
        length = np.array([len(w) - 1 for w in words])
        codes = np.frombuffer("".join(w[:-1] for w in words).encode("utf-32-le"), "<u4")
        column = np.arange(width + 1)
        ids = np.full((len(words), width + 1), -1, np.int64)
        ids[column < length[:, None]] = self._code[False][codes]
        ids[np.arange(len(words)), length - 1] = self._code[True][codes[np.cumsum(length) - 1]]
        done, word = ids.copy(), np.arange(len(words))
        rank, _ = self._pair(ids[:, :-1], ids[:, 1:])
        while len(word):
            best = rank.argmin(axis=1)
            row = np.arange(len(word))
            some = rank[row, best] < _NONE
            done[word[~some]] = ids[~some]
            ids, rank, word, best = ids[some], rank[some], word[some], best[some]
            row = row[:len(word)]
            _, made = self._pair(ids[row, best], ids[row, best + 1])
            later = column[:-1] > best[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ids[row, best] = made
            rank[:, :-1] = np.where(later[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = _NONE
            for place in (np.maximum(best - 1, 0), np.minimum(best, width - 1)):
                rank[row, place] = self._pair(ids[row, place], ids[row, place + 1])[0]
        return [r[:n] for r, n in zip(done.tolist(), (done >= 0).sum(axis=1).tolist())]

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of two tokens, or no rank, and what it makes."""
        key = a * self._size + b
        at = np.searchsorted(self._keys, key)
        found = (self._keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(found, self._ranks[at], _NONE), self._made[at]

    def _merge_long(self, word: str) -> list[int]:
        ids = [self._alphabet[s] for s in [*word[:-2], word[-2:]]]
        n, merges = len(ids), self._merges
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int, int]] = []  # rank, place, the pair as it was, what it makes

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) >= 0 and (found := merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, x, y, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in ids if t >= 0]

    def words(self, words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """``ids, lengths`` of words (byte characters without their end): guessed together, verified together."""
        ended = [w + _END for w in words]
        tokens: list[int] = []
        length = np.array([self.guess(w, tokens) for w in ended], np.int64)
        flat = np.array(tokens, np.int64)
        if len(flat) < 2:
            return flat, length
        owner = np.repeat(np.arange(len(ended)), length)
        inside = owner[1:] == owner[:-1]
        pair, place = np.unique(flat[:-1][inside] * self._size + flat[1:][inside], return_inverse=True)
        fits = self.compatible(pair // self._size, pair % self._size)
        failing = np.zeros(len(ended), bool)
        failing[owner[1:][inside][~fits[place]]] = True
        which = np.flatnonzero(failing)
        merged = self.merge([ended[k] for k in which.tolist()])
        kept = ~failing[owner]
        length[which] = [len(t) for t in merged]
        out = np.empty(length.sum(), np.int64)
        new = np.repeat(failing, length)
        out[~new] = flat[kept]
        out[new] = np.fromiter(chain.from_iterable(merged), np.int64, int(new.sum()))
        return out, length

    def _pieces(self, chunks: Sequence[str]) -> tuple[list[str], np.ndarray]:
        """The byte-character words of all chunks, distinct, and their numbers in order; 0 begins a chunk."""
        mine = [c for c in chunks if c[0] not in _MARKS]
        cut = iter(self._split_pieces("".join(f"\n{c}" for c in mine))) if mine else iter(())
        if len(mine) < len(chunks):  # special strings, and text that the library cuts
            by_chunk, current = [], None
            for piece in cut:
                if piece == "\n":
                    by_chunk.append(current := [piece])
                else:
                    current.append(piece)
            own = iter(by_chunk)
            cut = chain.from_iterable(next(own) if c[0] not in _MARKS else ["\n", c] if c[0] == "\0" else
                                      ["\n", *("\r" + w for w in self._library_words(c[1:]))] for c in chunks)
        numbers = _Numbers({"\n": 0})
        place = np.fromiter(map(numbers.__getitem__, cut), np.int64)
        return list(numbers)[1:], place

    def _learn(self, chunks: Sequence[str]) -> None:
        """The ids of new chunks, added to what is remembered."""
        if not chunks:
            return
        pieces, place = self._pieces(chunks)
        special = np.array([self.special[p[1:]] if p[0] == "\0" else -1 for p in pieces], np.int64)
        ordinary = [p if p.isascii() and p[0] != "\r" else p[1:] if p[0] == "\r" else
                    p.encode().decode("latin-1").translate(self._table) for p in pieces if p[0] != "\0"]
        ids, of_word = self.words(ordinary)
        length = np.zeros(len(pieces) + 1, np.int64)  # number 0 is the begin of a chunk
        length[1:][special < 0] = of_word
        length[1:][special >= 0] = 1
        begins = np.cumsum(length) - length
        flat = np.empty(length.sum(), np.int64)
        new = np.repeat(special >= 0, length[1:])
        flat[new], flat[~new] = special[special >= 0], ids
        count = length[place]
        taken = flat[_ranges(begins[place], count)]
        chunk = np.cumsum(place == 0) - 1
        per_chunk = np.bincount(chunk, count, minlength=len(chunks)).astype(np.int64)
        self._begins = np.concatenate([self._begins, self._begins[-1] + np.cumsum(per_chunk)])
        self._pool = np.concatenate([self._pool, taken.astype(np.int32)])

    def _library_words(self, text: str) -> list[str]:
        """Byte-character words of any text, normalised and cut by the library's tables."""
        clean = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]

    def _chunks(self, text: str) -> list[str]:
        """Keys of a text's parts, in order: special strings, runs without white space, or what the library must cut."""
        out = []
        for part in self._split.split(text) if self._split and "<|" in text else [text]:
            if part in self.special:
                out.append("\0" + part)
            elif _PLAIN.match(part):
                out += part.lower().split()
            else:
                out.append("\n" + part)
        return out  # plain runs begin with neither mark

    def encode_batch(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``ids, ends``: all ids of all texts in a row, and how many there are up to the end of each text.

        Special strings in a text are their own token.
        """
        parts, ends, held, chars = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [], 0
        for k, text in enumerate(texts, 1):
            held.append(text)
            chars += len(text or "")
            if chars >= SLICE_CHARS or k == len(texts):
                ids, until = self._encode_slice(held)
                ends.append(until + sum(map(len, parts)))
                parts.append(ids)
                held, chars = [], 0
        return np.concatenate(parts), np.concatenate(ends)

    def _encode_slice(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._memory) > REMEMBERED or len(self._pool) > REMEMBERED_IDS:
            self._forget()
        chunks = [self._chunks(t) if t else [] for t in texts]
        known = len(self._memory)
        ends = np.cumsum([len(held) for held in chunks])
        place = np.fromiter(map(self._memory.__getitem__, chain.from_iterable(chunks)), np.int64, int(ends[-1]))
        self._learn(list(islice(reversed(self._memory), len(self._memory) - known))[::-1])
        begin = self._begins[place]
        length = self._begins[place + 1] - begin
        until = np.concatenate([[0], np.cumsum(length)])
        return self._pool[_ranges(begin, length)], until[ends]


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``begin[k] ... begin[k] + length[k] - 1`` of all k in a row."""
    return np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def shown_tokens(path: str) -> list[str]:
    """What each id of the vocabulary at ``path`` decodes to."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokens = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens") or ()}}
    out = [""] * (max(tokens.values()) + 1)
    for token, i in tokens.items():
        out[i] = token
    return out


def decoded(ids: pa.ListArray, shown: pa.Array) -> pa.Array:
    """The tokens' strings with blanks between, special ones too: the vocabulary names no decoder."""
    tokens = pa.ListArray.from_arrays(ids.offsets, shown.take(ids.values))
    return pc.if_else(ids.is_valid(), pc.binary_join(tokens, " "), pa.scalar(None, pa.string()))


_loaded: dict[str, WordBPE] = {}
_shown: dict[str, pa.Array] = {}


def vocabulary(path: str) -> WordBPE:
    """One vocabulary per worker process and file."""
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text, one row per input row.

    A null or empty text has no ids; null ids, repeated rows and other columns
    change nothing; a word of any length is encoded whole.
    """
    prepared(docs.sparkSession)
    source = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(tokenizer_path)
        for batch in batches:
            ids, ends = bpe.encode_batch(batch.column(1).to_pylist())
            held = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), held], ["doc_id", "ids"])

    return source.mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a last column ``decoded``: the text of its ids, null for null."""
    prepared(encoded.sparkSession)
    def run(ids: pa.Array) -> pa.Array:
        if tokenizer_path not in _shown:
            _shown[tokenizer_path] = pa.array(shown_tokens(tokenizer_path), pa.string())
        return decoded(ids, _shown[tokenizer_path])

    return encoded.withColumn("decoded", F.arrow_udf(run, "string")(col(ids_col)))
