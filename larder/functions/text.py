"""Text column expressions."""

import sys
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import vocab


def strip(c: Column) -> Column:
    """Drop blanks of every kind at both ends (``trim`` knows the plain space only)."""
    return F.regexp_replace(c, rf"\A[{vocab.BLANK}]+|[{vocab.BLANK}]+\z", "")


def is_blank(c: Column) -> Column:
    """No character but blanks; stops at the first one, however long the text."""
    return ~c.rlike(f"[^{vocab.BLANK}]")


def squeeze(c: Column) -> Column:
    """Runs of blanks become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, vocab.BLANKS, " "))


def normalize_name(name: Column) -> Column:
    """Product name without packaging and size noise."""
    for pattern in vocab.NAME_NOISE:
        name = F.regexp_replace(name, pattern, " ")
    return squeeze(name)


def family_word(name: Column, skip_containers: bool = False) -> Column:
    """First word of the name that says what the product is; "" if there is none."""
    skipped = set(vocab.STOP_WORDS) | set(vocab.FORMAT_WORDS)
    if skip_containers:
        skipped |= set(vocab.CONTAINER_WORDS)
    passed = "|".join([*sorted(skipped), r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]+"])
    # Leftmost word of three letters or more that is not, as a whole, one to pass over.
    naming = rf"(?<![^ ])(?!(?:{passed})(?![^ ]))[^ ]{{3,}}"
    words = F.lower(normalize_name(F.coalesce(name, F.lit(""))))
    return F.regexp_extract(words, naming, 0)


def family(name: Column) -> Column:
    """Family of one product, packaging words skipped; null if there is none."""
    return F.nullif(family_word(name, skip_containers=True), F.lit(""))


@cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without marks, generated from the Unicode database.

    Returns the characters to translate, what they become (characters past its end are
    deleted), and the characters that expand to several. All planes of Unicode are covered.
    """
    single, marks, several = {}, [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF:
            continue
        if unicodedata.combining(char):
            marks.append(char)
            continue
        plain = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if plain == char:
            continue
        if len(plain) == 1:
            single[char] = plain
        else:
            several[char] = plain
    return "".join(single) + "".join(marks), "".join(single.values()), several


def _ranges(chars, gap: int = 16) -> list[tuple[int, int]]:
    """Few code point ranges that hold all ``chars`` (and some in between)."""
    found: list[tuple[int, int]] = []
    for code in sorted(map(ord, chars)):
        if found and code - found[-1][1] <= gap:
            found[-1] = (found[-1][0], code)
        else:
            found.append((code, code))
    return found


# Hangul syllables: first letters, vowels and last letters follow from the code by division.
_SYLLABLES, _FIRSTS, _VOWELS, _LASTS = 0xAC00, 0x1100, 0x1161, 0x11A7


def _hangul(code: Column) -> Column:
    """The letters of a Hangul syllable."""

    def letter(first: int, n: int, place: Column) -> Column:
        return F.substring(F.lit("".join(map(chr, range(first, first + n)))), place + 1, F.lit(1))

    place = code - _SYLLABLES
    div = lambda x, y: F.call_function("div", x, F.lit(y)).cast("int")
    last = place % 28
    ends = F.when(last > 0, letter(_LASTS, 28, last)).otherwise("")
    return F.concat(letter(_FIRSTS, 19, div(place, 588)), letter(_VOWELS, 21, div(place % 588, 28)), ends)


@cache
def _expansions() -> tuple[list[int], str]:
    """Pages of 256 characters that hold expanding ones, and what every character of them becomes ("" if itself)."""
    several = {ord(c): plain for c, plain in _fold_tables()[2].items() if not _SYLLABLES <= ord(c) < _SYLLABLES + 11_172}
    pages = sorted({code >> 8 for code in several})
    return pages, "\x01".join(several.get((page << 8) + i, "") for page in pages for i in range(256))


def _expanded(char: Column) -> Column:
    """What a character becomes: found by its place in a table, not by a search for it."""
    pages, table = _expansions()
    code = F.ascii(char)
    page = F.array_position(F.array(*map(F.lit, pages)), F.shiftright(code, 8)).cast("int")
    listed = F.get(F.split(F.lit(table), "\x01"), (page - 1) * 256 + code % 256)
    return (
        F.when(code < 0x80, char)
        .when(code.between(_SYLLABLES, _SYLLABLES + 11_171), _hangul(code))
        .when(page > 0, F.coalesce(F.nullif(listed, F.lit("")), char))
        .otherwise(char)
    )


def fold_word(word: Column) -> Column:
    """Grouping key of a word: no case, no accents, no plural ending."""
    before, after, several = _fold_tables()
    low = F.replace(F.lower(word), F.lit("œ"), F.lit("oe"))
    # Expanding characters (ligatures, fractions, Hangul): only words near one pay.
    expanding = "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _ranges(several)) + "]"
    spread = F.array_join(F.transform(F.split(low, ""), _expanded), "")
    plain = F.when(
        low.rlike(r"[^\x00-\x7f]"),
        F.translate(F.when(low.rlike(expanding), spread).otherwise(low), before, after),
    ).otherwise(low)
    plural = (F.length(plain) > 4) & F.right(plain, F.lit(1)).isin("s", "x")
    return F.when(plural, F.left(plain, F.length(plain) - 1)).otherwise(plain)


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    import html

    return text.map(html.unescape, na_action="ignore")


def unescape(c: Column) -> Column:
    """Replace HTML entities. Only texts with an ampersand travel to Python."""
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def clean_html(fragment: Column, max_chars: int | None = vocab.MAX_INGREDIENT_CHARS) -> Column:
    """HTML fragment, escaped once or twice, as plain text; "" for null."""
    text = F.regexp_replace(unescape(F.coalesce(fragment, F.lit(""))), "<[^>]+>", " ")
    text = squeeze(unescape(text))
    return text if max_chars is None else F.substring(text, 1, max_chars)


def drink_role_by_name(name: Column) -> Column:
    """Drink role that the name alone decides, else null."""
    return F.coalesce(
        *[F.when(name.rlike(pattern), role) for pattern, role in vocab.DRINK_NAME_RULES]
    )
