"""Brute-force counterparts and odd tables for the corpus operators."""

import re
from collections import defaultdict

SF_SMALL = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
LONG = "lorem ipsum dolor. " * 30_000

#: Null, empty, blank, very long and repeated texts, ties, null ids and sources.
ODD_ROWS = [
    (1, "one two three four five six", "en", "b"), (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "en", "b"),
    (None, "one two three four five six", "en", "b"), (None, None, None, None), (5, LONG, "de", "a"), (6, LONG, "de", None),
    (7, "one two three four five six", "en", "b"), (7, "one two three four five six", "en", "b"), (7, "Á é ß", "es", "ü"),
    (8, "x", None, "b"), (9, "a@b.co 1.2.3.4\r\nunder the MIT license", "fr", "b"),
]
CLASHING = ["n_words", "size", "kept", "rowkey", "spans", "labels", "score", "piece", "lot", "place", "_m", "_id", "n",
            "target", "taken", "fp", "component", "lang_pred", "copies", "key", "shard", "sid", "a.b", "_ledger"]


def odd_documents(spark, rows=ODD_ROWS):
    """``doc_id, text, lang, source, n_chars`` and extra columns named like operators' own."""
    data = [(i, t, lang, s, None if t is None else len(t), *range(len(CLASHING))) for i, t, lang, s in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` long" for c in CLASHING))


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def jaccard_classes(rows, k, percent):
    """Row number to the smallest linked row number, all pairs compared."""
    sets = [shingles(t, k) for t in rows]
    by_token, union = defaultdict(list), Union()
    for i, s in enumerate(sets):
        for g in s:
            by_token[g].append(i)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in by_token[g]:
                if j > i:
                    shared[j] += 1
        for j, o in shared.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                union.join(i, j)
    return [union.find(i) for i in range(len(sets))], [len(s) for s in sets]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d if d < 10 else d - 9
    return total % 10 == 0


def base_spans(text):
    """The four kinds by their plain patterns."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text or "")]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text or ""):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text or ""):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text or ""):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out
