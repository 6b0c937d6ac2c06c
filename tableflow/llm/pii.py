"""Personal data in texts, also where it is disguised.

Plain identifiers are found on the text itself.  For disguised ones a chain of
transducers rewrites the text (look-alike characters, ``[at]`` and ``dot``,
spelled digits) while keeping, for every character it writes, the source
characters it stands for.  Identifiers found in the rewritten text are mapped
back to source spans; offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, fresh, prepared
from tableflow.llm.top_labels import TOP_LABELS

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match can only start where the run of local characters before an ``@`` does."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Identifiers as they stand: leftmost, not overlapping within a kind, failing matches dropped."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return found
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


@dataclass(frozen=True)
class Mapped:
    """A text whose character ``k`` stands for source characters ``begins[k]`` up to ``ends[k]``."""

    text: str
    begins: array
    ends: array

    @staticmethod
    def of(text: str) -> Mapped:
        return Mapped(text, array("q", range(len(text))), array("q", range(1, len(text) + 1)))

    def rewrite(self, pattern: re.Pattern, write: Callable[[re.Match], str | None]) -> Mapped:
        """Every match replaced by what ``write`` gives (None: left alone).

        A replacement as long as the number of the match's ``items`` maps item by
        item; any other one stands for the whole match.
        """
        text, begins, ends, done = [], array("q"), array("q"), 0
        for m in pattern.finditer(self.text):
            new = write(m)
            if new is None:
                continue
            s, e = m.span()
            text.append(self.text[done:s])
            begins += self.begins[done:s]
            ends += self.ends[done:s]
            parts = [(x.start() + s, x.end() + s) for x in _ITEM.finditer(m[0])] if len(new) > 1 else []
            if len(parts) != len(new):
                parts = [(s, e)] * len(new)
            text.append(new)
            begins.extend(self.begins[a] for a, _ in parts)
            ends.extend(self.ends[b - 1] for _, b in parts)
            done = e
        if not done:
            return self
        return Mapped("".join([*text, self.text[done:]]), begins + self.begins[done:], ends + self.ends[done:])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.begins[start], self.ends[end - 1]


_ITEM = re.compile(r"[0-9]|[^\W0-9]+|[+.]")

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d",
    "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "к": "k", "т": "t", "м": "m", "н": "h", "в": "b",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "․": ".", "。": ".", "‧": ".", "﹒": ".", "﹫": "@", "﹢": "+", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
_HIDDEN = frozenset("\u00ad\u200b\u200c\u200d\u2060\ufeff")
_ODD = re.compile("[\u00ad\u0370-\U0010ffff]")


def _plain_character(m: re.Match) -> str | None:
    c = m[0]
    if c in _HIDDEN:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if 0xFF01 <= ord(c) <= 0xFF5E:  # full-width forms of ASCII
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.decimal(c, None)
    return None if digit is None else str(digit)


_OPEN, _CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_AT_WORD, _DOT_WORD = r"(?:at|arroba|ät|chez)", r"(?:dot|punkt|punto|point)"
_AT_BRACKET = re.compile(rf"{_OPEN}(?:{_AT_WORD}|@){_CLOSE}", re.I)
_DOT_BRACKET = re.compile(rf"{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}", re.I)
_NAME = r"[A-Za-z0-9_%+-]++"
_DOT = rf"(?:[ ](?:dot|punkt|punto)[ ]|{_OPEN}{_DOT_WORD}{_CLOSE})"
#: Last labels that an address spelled in words may have.
_LAST_LABEL = rf"(?:{'|'.join(sorted(TOP_LABELS, key=lambda w: (-len(w), w)))}|xn--[a-z0-9-]+)"
#: ``name at host dot com``: words count only in an address with a dot in words and a last label that exists.
_SPOKEN = re.compile(rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:(?:\.|{_DOT}){_NAME}){{0,4}}(?:[ ](?:at|arroba)[ ]|{_OPEN}{_AT_WORD}{_CLOSE}|@)"
                     rf"(?=[A-Za-z0-9.-]++{_DOT})"
                     rf"[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++){{0,5}}(?:\.|{_DOT}){_LAST_LABEL}(?![A-Za-z0-9-])", re.I)
_SPOKEN_PART = re.compile(rf"[ ]({_AT_WORD}|{_DOT_WORD})[ ]", re.I)
_HINT = re.compile(rf"[\[({{<][ \t]*(?:{_AT_WORD}|{_DOT_WORD}|@|\.)[ \t]*[\])}}>]|[ ]{_DOT_WORD}[ ]", re.I)

# The digits spelled out, 0 to 9, by language.
SPELLED_DIGITS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "zéro un deux trois quatre cinq six sept huit neuf",
)
_DIGIT_OF = {w: str(k) for words in SPELLED_DIGITS for k, w in enumerate(words.split())} | {"oh": "0"}
_SIGN_OF = {"plus": "+", "más": "+"}
_SPELLED = "|".join(sorted(_DIGIT_OF, key=lambda w: (-len(w), w)))
#: Seven spelled digits or more, with a plus before and dots between if spelled too.
_DIGIT_RUN = re.compile(rf"(?<!\w)(?:(?:plus|más|\+)[ -]?)?(?:{_SPELLED})(?:[ ,-]{{1,2}}(?:(?:dot|point|punkt|punto)[ ])?"
                        rf"(?:{_SPELLED})){{6,}}(?!\w)", re.I)
_DOT_SIGN = r"(?:[ ,-]{1,2}(?:dot|point|punkt|punto)[ ,-]{1,2}|\.)"
#: Spelled and plain digits in one run.
_MIXED_RUN = re.compile(rf"(?<!\w)(?:(?:plus|más|\+)[ -]?)?(?:{_SPELLED}|[0-9]++)"
                        rf"(?:(?:{_DOT_SIGN}|[ ,()-]{{1,3}})(?:{_SPELLED}|[0-9]++))+(?!\w)", re.I)
_ONE_DIGIT = rf"(?:{_SPELLED}|[0-9](?![0-9]))"
_NUMBER = rf"(?:[0-9]{{2,3}}(?![0-9])|{_ONE_DIGIT}(?:[ ,-]{{1,2}}{_ONE_DIGIT}){{0,2}})"
#: Four numbers of up to three digits with dots between, within such a run.
_SPELLED_IP = re.compile(rf"(?<!\w){_NUMBER}(?:{_DOT_SIGN}{_NUMBER}){{3}}(?!\w)", re.I)


def _may_spell(text: str) -> bool:
    """Whether seven spelled digits can follow each other: all but the outer two are words of their own."""
    words = text.lower().replace("-", " ").replace(",", " ").split()
    return sum(map(_DIGIT_OF.__contains__, words)) >= 5


def _digits(m: re.Match) -> str:
    out = []
    for w in _ITEM.findall(m[0]):
        w = w.lower()
        out.append(w if w == "+" or w.isdecimal() else _DIGIT_OF.get(w) or _SIGN_OF.get(w) or ".")
    return "".join(out)


def _joined(m: re.Match) -> str | None:
    """The digits of a run with a word in it that can be an identifier: seven, or four numbers with dots."""
    new = _digits(m)
    dots = new.count(".")
    if not any(map(str.isalpha, m[0])) or (dots < 3 and len(new) - dots - new.count("+") < 7):
        return None
    return new


_TOP = re.compile(_LAST_LABEL, re.I)
#: ``@`` and ``.`` as character references and percent codes.
_CODED = re.compile(r"&#0*64;|&#x0*40;|&commat;|%40|&#0*46;|&#x0*2e;|&period;|%2e", re.I)
#: A comma for the last dot of an address.
_COMMA = re.compile(rf"(?<=@)[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+,{_LAST_LABEL}(?![A-Za-z0-9-])", re.I)
_DOMAIN_AHEAD = rf"(?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*?\.{_LAST_LABEL}(?![A-Za-z0-9-]))"
#: An ``@`` with blanks around, or an ``a`` in brackets, before a domain.
_APART = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?:[ ]{{0,2}}@[ ]{{1,2}}|[ ]{{1,2}}@|[ ]?[\[({{<]a[\])}}>][ ]?){_DOMAIN_AHEAD}", re.I)
#: ``name_at_host_dot_com``, with underscores or hyphens.
_SNAKE = re.compile(rf"(?<![A-Za-z0-9_-])[A-Za-z0-9%+.]++(?P<x>[_-])at(?P=x)[A-Za-z0-9]++(?:(?P=x)dot(?P=x)[A-Za-z0-9]++)*?"
                    rf"(?P=x)dot(?P=x){_LAST_LABEL}(?![A-Za-z0-9_-])", re.I)
#: Single characters with a blank between.
_SPACED = re.compile(r"(?<![A-Za-z0-9])(?:[A-Za-z0-9._%+-] ){2,64}@ (?:[A-Za-z0-9-] ){1,64}(?:\. (?:[A-Za-z0-9-] ){0,63}[A-Za-z0-9-](?: (?=\.))?){1,6}"
                     r"(?![A-Za-z0-9])(?! [A-Za-z0-9](?![A-Za-z0-9]))")
_LETTER_DIGITS = str.maketrans("OolI", "0011")
#: Letters among the digits of a card or of an address in numbers.
_LETTERED = re.compile(r"(?<![A-Za-z0-9])(?:[0-9OolI](?:[ -]?[0-9OolI]){15,18}|[0-9OolI]{1,3}(?:\.[0-9OolI]{1,3}){3})(?![A-Za-z0-9]|\.[0-9])")
_LETTERED_HINT = re.compile(r"[0-9][ .-]?[OolI]{1,3}(?![A-Za-z])|(?<![A-Za-z])[OolI]{1,3}[ .-]?[0-9]")
# English number words, and words that repeat the next digit.
_TEENS = "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen"
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety"
_REPEATS = {"double": 2, "triple": 3}
_VALUE = ({w: k for k, w in enumerate(SPELLED_DIGITS[0].split())} | {w: 10 + k for k, w in enumerate(_TEENS.split())}
          | {w: 20 + 10 * k for k, w in enumerate(_TENS.split())})
_WORD_OF_NUMBER = rf"(?:{'|'.join(sorted([*_VALUE, 'hundred', 'and'], key=lambda w: (-len(w), w)))})"
_NUMBERS = rf"{_WORD_OF_NUMBER}(?:[ -]{_WORD_OF_NUMBER}){{0,5}}"
#: Four numbers in words with dots between.
_WORDED_IP = re.compile(rf"(?<!\w)(?:{_NUMBERS}|[0-9]{{1,3}})(?:[ ](?:dot|point)[ ](?:{_NUMBERS}|[0-9]{{1,3}})){{3}}(?!\w)", re.I)
#: A run of digits with ``double`` or ``triple`` in it.
_REPEATED = re.compile(rf"(?<!\w)(?:(?:plus|\+)[ -]?)?(?:(?:(?:double|triple)[ ])?(?:{_SPELLED}|[0-9]++)[ ,-]{{1,2}}){{2,}}"
                       rf"(?:(?:double|triple)[ ])?(?:{_SPELLED}|[0-9]++)(?!\w)", re.I)


#: Some sign of any of these.
_RARE_HINT = re.compile(rf"@|&#|&commat;|&period;|%40|%2e|[\[({{<]a[\])}}>]|[_-]at[_-]|[ ](?:dot|point)[ ]|(?:double|triple)[ ]|{_LETTERED_HINT.pattern}", re.I)


def _sign_of_code(m: re.Match) -> str:
    return "@" if re.search("64|40|commat", m[0], re.I) else "."


def _snake_address(m: re.Match) -> str:
    x = m["x"]
    return re.sub(f"{x}at{x}", "@", re.sub(f"{x}dot{x}", ".", m[0], flags=re.I), count=1, flags=re.I)


def _spaced_address(m: re.Match) -> str | None:
    joined = m[0].replace(" ", "")
    return joined if _TOP.fullmatch(joined.rpartition(".")[2]) else None


def _lettered_number(m: re.Match) -> str | None:
    digits = sum(map(str.isdecimal, m[0]))
    if digits == len(m[0]) or 3 * digits < 2 * sum(c.isalnum() for c in m[0]):
        return None
    return m[0].translate(_LETTER_DIGITS)


def _number_of(words: str) -> int | None:
    """``one hundred ninety two`` and ``one sixty eight`` alike; None if it is no number as people say it."""
    if words.isdecimal():
        return int(words)
    total, last = 0, 0
    for w in words.lower().replace("-", " ").split():
        if w == "and":
            continue
        if w == "hundred":
            if not 0 < total < 10:
                return None
            total, last = total * 100, 100
        else:
            value = _VALUE[w]
            if last == 100 or (last >= 20 and last % 10 == 0 and 0 < value < 10):
                total += value
            elif last == 0 and total == 0:
                total = value
            else:  # said digit by digit, or as one and sixty eight
                total = total * (100 if value >= 10 else 10) + value
            last = value or 1
    return total


def _worded_address(m: re.Match) -> str | None:
    numbers = [_number_of(x) for x in re.split(r"[ ](?:dot|point)[ ]", m[0], flags=re.I)]
    return ".".join(map(str, numbers)) if all(n is not None and n <= 255 for n in numbers) else None


def _repeated_digits(m: re.Match) -> str | None:
    out, times = [], 1
    for w in _ITEM.findall(m[0]):
        w = w.lower()
        if w in _REPEATS:
            times = _REPEATS[w]
        else:
            out.append((w if w == "+" or w.isdecimal() else _DIGIT_OF.get(w) or _SIGN_OF.get(w, "")) * times)
            times = 1
    new = "".join(out)
    return new if len(new) > 7 and re.search("double|triple", m[0], re.I) else None


def _more_readings(mapped: Mapped) -> list[Mapped]:
    """Readings by the rarer disguises; each step runs only on texts that show its signs."""
    text, lower, out = mapped.text, mapped.text.lower(), mapped
    if "&" in text or "%40" in text or "%2e" in lower:
        out = out.rewrite(_CODED, _sign_of_code)
    if "@" in out.text:
        out = out.rewrite(_SPACED, _spaced_address)
        out = out.rewrite(_COMMA, lambda m: m[0].replace(",", "."))
    if "@" in out.text or re.search(r"[\[({<]a[\])}>]", lower):
        out = out.rewrite(_APART, lambda m: "@")
    if "_at_" in lower or "-at-" in lower:
        out = out.rewrite(_SNAKE, _snake_address)
    if " dot " in lower or " point " in lower:
        out = out.rewrite(_WORDED_IP, _worded_address)
    if "double " in lower or "triple " in lower:
        out = out.rewrite(_REPEATED, _repeated_digits)
    if _LETTERED_HINT.search(out.text):
        out = out.rewrite(_LETTERED, _lettered_number)
    return [] if out is mapped else [out]


def normalise(text: str) -> list[Mapped]:
    """Readings of the text without disguises, none if it shows no sign of any.

    The first joins digits that are all spelled; the others, where they differ, four
    numbers with dots, then spelled and plain digits alike, then the rarer disguises:
    character codes, blanks or commas in addresses, ``_at_``, number words above
    nine, ``double`` digits and letters among digits.
    """
    odd = _ODD.search(text)
    if not odd and not _RARE_HINT.search(text):
        return _readings(text)
    plain = Mapped.of(text).rewrite(_ODD, _plain_character) if odd else Mapped.of(text)
    return [*_readings(text), *_more_readings(plain)]


def _readings(text: str) -> list[Mapped]:
    odd, hint = _ODD.search(text), _HINT.search(text)
    run = _may_spell(text) and _DIGIT_RUN.search(text)
    if not (odd or hint or run or any(map(_joined, _MIXED_RUN.finditer(text)))):
        return []
    mapped = Mapped.of(text)
    if odd:
        mapped = mapped.rewrite(_ODD, _plain_character)
    if _HINT.search(mapped.text):
        spoken = iter([m.span() for m in _SPOKEN.finditer(mapped.text)])
        now = next(spoken, None)

        def sign(m: re.Match) -> str | None:
            nonlocal now
            while now and now[1] <= m.start():
                now = next(spoken, None)
            if not now or m.start() < now[0]:
                return None
            return "@" if re.fullmatch(_AT_WORD, m[1], re.I) else "."

        mapped = mapped.rewrite(_SPOKEN_PART, sign)
        mapped = mapped.rewrite(_AT_BRACKET, lambda m: "@").rewrite(_DOT_BRACKET, lambda m: ".")
    others = [mapped.rewrite(p, _joined) for p in (_SPELLED_IP, _MIXED_RUN)]
    first = mapped.rewrite(_DIGIT_RUN, _digits) if run or odd else mapped
    return [first, *(m for m in others if m is not mapped)]


def find_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """``(kind, start, end, disguised)`` by kind, then start.

    Plain spans always stay; a disguised one is added if it reaches beyond those
    of its kind that it meets.  A null or empty text has none.
    """
    if not text:
        return []
    found = [(*s, False) for s in plain_spans(text)]
    for mapped in normalise(text):
        taken = {k: sorted((s, e) for x, s, e, _ in found if x == k) for k in KINDS}
        reach = {k: list(accumulate((e for _, e in v), max)) for k, v in taken.items()}
        for kind, s, e in plain_spans(mapped.text):
            a, b = mapped.source(s, e)
            before = bisect_right(taken[kind], (a, len(text))) - 1
            if before < 0 or reach[kind][before] < b:
                found.append((kind, a, b, True))
    return sorted(found, key=lambda f: (KINDS.index(f[0]), f[1], f[2]))


def redact(text: str | None) -> str | None:
    """The text with every identifier replaced by its kind in brackets; overlapping ones together."""
    if text is None:
        return None
    out, done = [], 0
    for kind, s, e, _ in sorted(find_spans(text), key=lambda f: (f[1], -f[2])):
        if s >= done:
            out += [text[done:s], f"[{kind}]"]
        done = max(done, e)
    return "".join([*out, text[done:]]) if done else text


_SPANS = "array<struct<kind:string, start:long, end:long, disguised:boolean>>"


def _find_batch(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": s, "end": e, "disguised": d} for k, s, e, d in find_spans(t)]
                      for t in texts], dtype=object)


def _redact_batch(texts: pd.Series) -> pd.Series:
    return pd.Series([redact(t) for t in texts], dtype=object)


def spans_column(text: Column) -> Column:
    return F.pandas_udf(_find_batch, _SPANS)(text)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans``: one row per input row, ids null or repeated included; other columns are not carried.

    A null or empty text has no spans; an empty table gives no rows.
    """
    prepared(docs.sparkSession)
    out_id = fresh(["spans"], id_col)
    return docs.select(col(id_col).alias(out_id), spans_column(col(text_col)).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with identifiers replaced; ``chars_col``, if given, gets the new length.

    A null text stays null; null ids and repeated rows stay; an empty table stays empty.
    """
    prepared(docs.sparkSession)
    out = docs.withColumn(text_col, F.pandas_udf(_redact_batch, "string")(col(text_col)))
    if chars_col:
        out = out.withColumn(chars_col, F.length(col(text_col)).cast("long"))
    return out.select(*[col(c) for c in docs.columns])
