"""Hungarian text normalization and word error rates."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hungarian number words and symbol words.
UNITS = ["nulla", "egy", "kettő", "három", "négy", "öt", "hat", "hét", "nyolc", "kilenc"]
TENS = ["", "tíz", "húsz", "harminc", "negyven", "ötven", "hatvan", "hetven", "nyolcvan", "kilencven"]
TENS_BEFORE_UNITS = {1: "tizen", 2: "huszon"}
SCALES = [(10**12, "billió"), (10**9, "milliárd"), (10**6, "millió"), (10**3, "ezer")]
FRACTIONS = ["", "tized", "század", "ezred", "tízezred", "százezred", "milliomod"]
SYMBOLS = {"%": "százalék", "‰": "ezrelék", "€": "euró", "$": "dollár", "&": "és", "+": "plusz", "=": "egyenlő", "§": "paragrafus", "°": "fok"}
LETTERS = "a-záéíóöőúüű"

#: Cardinals are generated below this.
LIMIT = 10**15
#: Up to here a number is one word; above, a hyphen sets the groups of thousands apart.
ONE_WORD = 2000


def _below_thousand(n: int, joined: bool) -> str:
    """``joined``: another word follows, before which two is ``két``."""
    hundreds, rest = divmod(n, 100)
    tens, units = divmod(rest, 10)
    unit = "két" if units == 2 and joined else UNITS[units]
    word = "" if not hundreds else ("" if hundreds == 1 else "két" if hundreds == 2 else UNITS[hundreds]) + "száz"
    if tens:
        word += TENS_BEFORE_UNITS.get(tens, TENS[tens]) if units else TENS[tens]
    return word + (unit if units or not n else "")


def cardinal(n: int) -> str:
    """The number in words: 2010 is kétezer-tíz, 1999 is one word."""
    if n >= LIMIT:
        raise ValueError(f"{n} is beyond the cardinals")
    parts, rest = [], n
    for scale, name in SCALES:
        count, rest = divmod(rest, scale)
        if count:
            parts.append(("" if count == 1 and scale == 1000 and not parts else _below_thousand(count, True)) + name)
    if rest or not parts:
        parts.append(_below_thousand(rest, False))
    return ("-" if n > ONE_WORD else "").join(parts)


def decimal(whole: str, fraction: str) -> str:
    """A decimal in words: 5,5 is öt egész öt tized; zeros at the end don't count."""
    digits = fraction.rstrip("0") or "0"
    if len(digits) >= len(FRACTIONS):
        raise ValueError("too many decimals")
    return f"{cardinal(int(whole))} egész {cardinal(int(digits))} {FRACTIONS[len(digits)]}"


_SUFFIXED = re.compile(rf"\b(\d+)-([{LETTERS}]+)\b")
_DECIMAL = re.compile(r"\b(\d+),(\d+)\b")
_INTEGER = re.compile(r"\b\d+\b")


def _or_as_is(make):
    """A number that has no words here stays as it is."""

    def words(match: re.Match) -> str:
        try:
            return make(match)
        except ValueError:
            return match[0]

    return words


def spell_numbers(text: str | None) -> str | None:
    """Composed, lower-cased, and with numbers in words; suffixes join their number."""
    if not text:
        return text
    text = unicodedata.normalize("NFC", text).lower()
    if not any(c.isdigit() for c in text):
        return text
    text = _SUFFIXED.sub(_or_as_is(lambda m: cardinal(int(m[1])).replace("-", "") + m[2]), text)
    text = _DECIMAL.sub(_or_as_is(lambda m: decimal(m[1], m[2])), text)
    return _INTEGER.sub(_or_as_is(lambda m: cardinal(int(m[0]))), text)


@F.pandas_udf(T.StringType())
def _spell(column):
    return column.map(spell_numbers, na_action="ignore")


def plain_words(text: Column) -> Column:
    """Symbols in words, everything but letters, digits and underscores as single spaces."""
    # The text is bound once; each mention of an expression would be evaluated anew.
    return F.get(F.transform(F.array(text), _plain_words), F.lit(0))


def _plain_words(text: Column) -> Column:
    any_symbol, suffixed = F.lit(False), text
    for symbol in SYMBOLS:
        any_symbol = any_symbol | F.contains(text, F.lit(symbol))
    for symbol, word in SYMBOLS.items():
        suffixed = F.regexp_replace(suffixed, f"\\Q{symbol}\\E-([{LETTERS}]+)(?U)\\b", f" {word}$1 ")
    spelled = F.when(text.rlike(f"[{''.join(SYMBOLS)}]-[{LETTERS}]"), suffixed).otherwise(text)
    for symbol, word in SYMBOLS.items():
        spelled = F.replace(spelled, F.lit(symbol), F.lit(f" {word} "))
    text = F.when(any_symbol, spelled).otherwise(text)
    return F.btrim(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " "))


#: What Python has to see: decimal digits, and characters that may compose with others or aren't composed.
_INVOLVED = r"[\p{Nd}\x{300}-\x{10FFFF}]"


def normalize(text: Column) -> Column:
    """Normalized text; null and empty texts stay as they are.

    Only texts with numbers, or with characters beyond the composed Latin ones, go through Python.
    """
    from ..runtime import ship
    from pyspark.sql import SparkSession

    ship(SparkSession.active())
    involved = text.rlike(_INVOLVED)
    return F.when(text == "", text).otherwise(plain_words(F.when(involved, _spell(F.when(involved, text))).otherwise(F.lower(text))))


def words(text: Column) -> Column:
    """The words of normalized text; none for an empty or null one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")


def edits(a: Column, b: Column) -> Column:
    """Levenshtein distance of two arrays by rows of a table, without Python; for short arrays."""
    first = F.sequence(F.lit(0), F.size(b))

    def row(before: Column, word: Column) -> Column:
        """The next row from the one before, cell by cell."""
        return F.aggregate(
            F.transform(b, lambda w, j: F.struct(w.alias("w"), j.alias("j"))),
            F.array(F.get(before, F.lit(0)) + 1),
            lambda done, x: F.array_append(
                done,
                F.when(word == x["w"], F.get(before, x["j"])).otherwise(
                    1 + F.least(F.get(before, x["j"] + 1), F.element_at(done, -1), F.get(before, x["j"]))
                ),
            ),
        )

    return F.element_at(F.aggregate(a, first, row), -1)


def _rate(errors: Column, reference: Column, hypothesis: Column) -> Column:
    n, m = F.size(reference), F.size(hypothesis)
    return F.when(n == 0, F.when(m == 0, 0.0).otherwise(1.0)).when(m == 0, 1.0).otherwise(errors / n)


def wer_short(reference: Column, hypothesis: Column) -> Column:
    """Word error rate of arrays of words, without Python."""
    return _rate(edits(reference, hypothesis), reference, hypothesis)


def edit_distance(a: list, b: list) -> int:
    """Levenshtein distance: a row of the table at a time, its differences as bits of two integers.

    Equal beginnings and ends are left out first, as they never change the distance.  Then bits
    say where a cell is one more or one less than its left neighbour (Myers, Hyyrö), so that a row
    takes a few operations on integers of as many bits as the shorter list has words.
    """
    at, end = 0, min(len(a), len(b))
    while at < end and a[at] == b[at]:
        at += 1
    last = 0
    while last < end - at and a[-1 - last] == b[-1 - last]:
        last += 1
    a, b = a[at : len(a) - last], b[at : len(b) - last]
    if len(b) > len(a):
        a, b = b, a
    if not b:
        return len(a)
    places: dict = {}
    for j, word in enumerate(b):
        places.setdefault(word, []).append(j)
    masks, size = {}, len(b) + 7 >> 3
    for word in places.keys() & set(a):
        bits = bytearray(size)
        for j in places[word]:
            bits[j >> 3] |= 1 << (j & 7)
        masks[word] = int.from_bytes(bits, "little")
    full, top, distance = (1 << len(b)) - 1, len(b) - 1, len(b)
    more, less = full, 0
    for word in a:
        same = masks.get(word, 0)
        diagonal = ((same & more) + more ^ more) | same | less
        up, down = less | full & ~(diagonal | more), diagonal & more
        distance += (up >> top & 1) - (down >> top & 1)
        up = up << 1 | 1
        down <<= 1
        more, less = full & (down | ~(diagonal | up)), full & up & diagonal
    return distance


@F.pandas_udf(T.IntegerType())
def _distance(a, b):
    import pandas as pd

    return pd.Series([edit_distance(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="int32")


def wer(reference: Column, hypothesis: Column) -> Column:
    """Word error rate of arrays of words of any length; it is not symmetric and may pass 1."""
    from ..runtime import ship
    from pyspark.sql import SparkSession

    ship(SparkSession.active())
    return _rate(_distance(reference, hypothesis), reference, hypothesis)
