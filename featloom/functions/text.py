"""Text expressions. Everything here stays in the JVM; no Python runs per row."""

from __future__ import annotations

import functools
import re
import string
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as whitespace when stripping text (every Unicode space and separator).
WHITESPACE = "".join(chr(p) for p in range(0x3001) if chr(p).isspace())

# Tokens that stand for a missing value, after strip and lower.
MISSING_TOKENS = ("\\n", "nan", "none", "null", "na", "-", "?", "")

# Whole-cell pattern of a missing value, any case.
MISSING_PATTERN = r"(?i)^(?:\s*|\\N|\\n|nan|none|null|na|-|\?)$"

# Substrings flagged in titles.
TITLE_PATTERNS = ("part", "return")

YEAR_SUFFIX = r" \(\d{4}\)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove all leading and trailing whitespace, not only blanks (linear time, no regex)."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def normalize_text(c: Column | str, lower: bool = True) -> Column:
    out = strip(c)
    return F.lower(out) if lower else out


def null_if_missing_token(c: Column | str, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """NULL where the stripped, lower-cased cell is one of ``tokens``; else the cell unchanged.

    One anchored pattern, which leaves a long cell at its first character.
    """
    c = _col(c)
    gap = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITESPACE) + "]*+"
    choices = "|".join(re.escape(t) for t in tokens if t)
    blank = "?" if "" in tokens else ""
    return F.when(c.rlike(rf"(?i)\A{gap}(?:(?:{choices}){gap}){blank}\z"), F.lit(None)).otherwise(c)


def null_if_missing_pattern(c: Column | str, pattern: str = MISSING_PATTERN) -> Column:
    c = _col(c)
    return F.when(c.rlike(pattern), F.lit(None)).otherwise(c)


def strip_year_suffix(c: Column | str) -> Column:
    """Drop one trailing `` (YYYY)``."""
    return F.regexp_replace(_col(c), YEAR_SUFFIX, "")


def split_camel(c: Column | str) -> Column:
    """Put a blank before each capital; text before the first capital is dropped."""
    return F.array_join(F.regexp_extract_all(_col(c), F.lit("([A-Z][^A-Z]*)"), F.lit(1)), " ")


def strip_punctuation(c: Column | str) -> Column:
    """Remove the 32 ASCII punctuation marks."""
    return F.translate(_col(c), string.punctuation, "")


def strip_control(c: Column | str) -> Column:
    """Remove characters of Unicode category C."""
    return F.regexp_replace(_col(c), r"\p{C}+", "")


@functools.lru_cache(maxsize=1)
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Per-character compatibility decomposition reduced to ASCII, from the Unicode tables.

    Decomposition works character by character once the non-ASCII rest is dropped
    (reordering only moves combining marks), so a lookup table is exact. Returns
    the one-to-one part and the one-to-many part.
    """
    single: dict[str, str] = {}
    multiple: dict[str, str] = {}
    for point in range(0x80, 0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        char = chr(point)
        folded = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            single[char] = folded
        elif folded:
            multiple[char] = folded
    return single, multiple


def ascii_fold(c: Column | str) -> Column:
    """Decompose (NFKD) and keep ASCII only: ``é`` -> ``e``, ``ﬁ`` -> ``fi``, ``ß`` dropped.

    Three branches, so that plain ASCII text costs one scan, accented text a
    ``translate``, and only text with a one-to-many character is split up.
    """
    c = _col(c)
    single, multiple = _ascii_folds()
    non_ascii = r"[^\x00-\x7F]+"
    has_multiple = F.length(F.translate(c, "".join(multiple), "")) < F.length(c)
    table = F.map_from_arrays(F.split(F.lit("".join(multiple)), ""), F.split(F.lit("\x00".join(multiple.values())), "\x00"))
    expanded = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.when(ch < "\x80", ch).otherwise(F.coalesce(table[ch], ch))),
        "",
    )

    def to_ascii(x: Column) -> Column:
        return F.regexp_replace(F.translate(x, "".join(single), "".join(single.values())), non_ascii, "")

    return F.when(~c.rlike(non_ascii), c).when(has_multiple, to_ascii(expanded)).otherwise(to_ascii(c))


# Letters whose name does not show their sound.
LETTER_NAMES = {
    "SHARP S": "ss", "ETH": "d", "THORN": "th", "ENG": "ng", "KRA": "q", "LONG S": "s", "SCHWA": "e", "OPEN E": "e", "OPEN O": "o", "EZH": "zh", "ESH": "sh",
    "WYNN": "w", "YOGH": "y", "HWAIR": "hv", "GAMMA": "g", "IOTA": "i", "UPSILON": "u", "ALPHA": "a", "DOTLESS I": "i", "DOTLESS J": "j", "CHI": "kh",
    "HARD SIGN": "", "SOFT SIGN": "", "YERU": "y", "GHE": "g", "IE": "e", "SHORT I": "i", "KHA": "kh", "HA": "kh", "AIN": "a", "AYIN": "a", "ALEF": "a", "HAMZA": "",
    "THAL": "dh", "TATWEEL": "", "BYELORUSSIAN-UKRAINIAN I": "i", "UKRAINIAN IE": "ye",
}
LETTERS = 8  # a character of more letters (some whole words written as one) is dropped
SOUNDS = ("TH", "PH", "CH", "PS", "TS", "SH", "KH", "GH", "DZ", "ZH", "SHCH")


def _romanized(char: str) -> str | None:
    """ASCII letters for one character, read from its Unicode name; None where the name tells none."""
    name = unicodedata.name(char, "")
    script, _, rest = name.partition(" ")
    small = " CAPITAL " not in f" {name} " or not char.isupper()
    if script == "HANGUL" and rest.startswith("SYLLABLE "):
        return rest.removeprefix("SYLLABLE ").lower()
    if " LETTER " not in f" {rest} " and " LIGATURE " not in f" {rest} ":
        return None
    letter = re.split(r"\b(?:LETTER|LIGATURE) ", rest, maxsplit=1)[-1]
    letter = re.sub(r" (?:WITH|ABOVE|DIGRAPH|SYMBOL)\b.*| (?:ISOLATED|INITIAL|MEDIAL|FINAL) FORM$", "", letter)
    letter = re.sub(r"^(?:FINAL|SMALL|SMALL CAPITAL|TURNED|REVERSED|BARRED|AFRICAN|LATIN|HALFWIDTH) ", "", letter)
    if letter in LETTER_NAMES:
        sound = LETTER_NAMES[letter]
    elif script in ("HIRAGANA", "KATAKANA"):
        sound = letter.lower() if letter.isalpha() else None
    elif script == "LATIN":
        sound = letter.lower() if re.fullmatch("[A-Z]{1,2}", letter) else None
    elif script in ("GREEK", "HEBREW", "ARABIC"):
        first = next((s for s in SOUNDS if letter.startswith(s)), letter[:1])
        sound = ("kh" if script == "GREEK" and first == "CH" else first.lower()) if first.isalpha() else None
    elif script == "CYRILLIC":
        held = letter.split(" ")[-1]
        if re.fullmatch("[AEIOUY][AEIOUY]?", held):
            sound = held.lower()
        else:
            sound = (held[1:] if re.fullmatch("E[LMNRSF]", held) else re.sub("[AEIOU]+$", "", held)).lower()
    else:
        sound = None
    return None if sound is None else sound if small else sound.capitalize()


@functools.lru_cache(maxsize=1)
def _romanizations() -> dict[str, str]:
    """ASCII for every character of the basic plane that decomposes to it or whose name tells its sound."""
    out = {}
    for point in range(0x80, 0x10000):
        if 0xD800 <= point < 0xE000:
            continue
        char = chr(point)
        parts = unicodedata.normalize("NFKD", char)
        plain = parts.encode("ascii", "ignore").decode("ascii")
        held = [_romanized(char)] if char == parts else [_romanized(p) if not p.isascii() else p for p in parts if not unicodedata.combining(p)]
        if unicodedata.name(char, "").startswith(("HANGUL SYLLABLE", "HIRAGANA", "KATAKANA")):
            held = [_romanized(char)]
        sound = "".join(h for h in held if h) if any(h is not None for h in held) else plain
        if sound and sound.isascii() and len(sound) <= LETTERS:
            out[char] = sound
    return out


def transliterate(c: Column | str) -> Column:
    """ASCII in place of letters: ``é`` -> ``e``, ``ß`` -> ``ss``, ``ł`` -> ``l``, ``Ж`` -> ``Zh``, ``λ`` -> ``l``, ``か`` -> ``ka``.

    Latin letters with strokes and ligatures, Greek, Cyrillic, Hebrew, Arabic, kana
    and Hangul are read from the characters' names; other characters beyond ASCII
    are dropped. A character of several letters is spread over as many columns of
    one-to-one translations, which are then read across, so that long texts and large
    tables of letters cost no look-up per character. Plain ASCII is left as it is.
    """
    c = _col(c)
    table = _romanizations()
    of = lambda low, high: {k: v for k, v in table.items() if low <= len(v) <= high}
    single = of(1, 1)
    blank = "\ue000"  # a private character that stands for no letter

    def ascii_only(x: Column) -> Column:
        return F.regexp_replace(F.translate(x, "".join(single), "".join(single.values())), r"[^\x00-\x7F]+", "")

    def spread(width: int) -> Column:
        longer = of(2, width)
        keys = "".join(longer)
        columns = [F.split(F.translate(c, keys, "".join(v[0] for v in longer.values())), "")]
        others = F.regexp_replace(c, r"[\x00-\x7F]", blank)
        for k in range(1, width):
            nth = F.translate(others, keys, "".join(v[k] if len(v) > k else blank for v in longer.values()))
            # What has no letters of its own must not be shown again.
            columns.append(F.split(F.regexp_replace(nth, r"[^\x00-\x7F]", blank), ""))
        across = functools.reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), columns)
        return ascii_only(F.translate(F.array_join(across, ""), blank, ""))

    has = lambda low: F.length(F.translate(c, "".join(of(low, LETTERS)), "")) < F.length(c)
    return F.when(~c.rlike(r"[^\x00-\x7F]"), c).when(has(3), spread(LETTERS)).when(has(2), spread(2)).otherwise(ascii_only(c))


def embedding_clean(c: Column | str, null_as_empty: bool = False) -> Column:
    """Strip, drop control characters, lower, fold to ASCII; order and punctuation stay."""
    out = ascii_fold(F.lower(strip_control(strip(c))))
    return F.coalesce(out, F.lit("")) if null_as_empty else out


def tfidf_clean(c: Column | str) -> Column:
    """Strip and remove punctuation; NULL becomes the empty text."""
    return F.coalesce(strip_punctuation(strip(c)), F.lit(""))


def _fingerprint_tokens(c: Column | str) -> Column:
    folded = ascii_fold(strip_control(strip_punctuation(F.lower(strip(c)))))
    return F.filter(F.split(folded, r"\s+"), lambda t: t != "")


def fingerprint(c: Column | str, sort: bool = True) -> Column:
    """Key for near-equal texts: folded tokens, sorted and unique, or in text order."""
    tokens = _fingerprint_tokens(c)
    if sort:
        tokens = F.array_sort(F.array_distinct(tokens))
    return F.array_join(tokens, " ")


def length_without_blanks(c: Column | str) -> Column:
    return F.coalesce(F.length(F.replace(_col(c), F.lit(" "), F.lit(""))), F.lit(0))


def contains_flag(c: Column | str, pattern: str) -> Column:
    """1 where the text contains ``pattern`` (case-sensitive), else 0; NULL gives 0."""
    return F.coalesce(F.contains(_col(c), F.lit(pattern)).cast("int"), F.lit(0))


def words(c: Column | str, pattern: str) -> Column:
    """All matches of ``pattern`` in the lower-cased text, in text order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(f"({pattern})"), F.lit(1))


def _runs(held: Column, word: Callable[[Column], Column], out: Callable[[Column, Column, Column], Column]) -> Column:
    """``out`` of each run of equal words in a list once it is sorted: the list, where the run begins, where it ends."""
    # One-element transforms hold a list, so that it is made once however often it is used.
    once = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    begins = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (word(F.get(s, i)) != word(F.get(s, i - 1))))
    ends = lambda s, b: F.concat(F.slice(b, 2, F.size(b)), F.array(F.size(s)))
    runs = lambda s: once(begins(s), lambda b: F.zip_with(b, ends(s, b), lambda i, j: out(s, i, j)))
    return once(held, lambda x: F.when(F.size(x) > 0, once(F.sort_array(x), runs)))


def counted(held: Column) -> Column:
    """``array<struct<word, n>>``: each word of a list once, with how often it is there; null for an empty list.

    A row is counted by itself: no row per word is moved, or kept in a map of a task.
    """
    return _runs(held, lambda x: x, lambda s, i, j: F.struct(F.get(s, i).alias("word"), (j - i).cast("long").alias("n")))


def placed(held: Column) -> Column:
    """``array<struct<word, places>>``: each word of a list once, with its places in it (from 0) in their order; null for an empty list."""
    places = lambda s, i, j: F.transform(F.slice(s, i + 1, j - i), lambda x: x.at)
    at = F.transform(held, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    return _runs(at, lambda x: x.word, lambda s, i, j: F.struct(F.get(s, i).word.alias("word"), places(s, i, j).alias("places")))


def parse_categories(c: Column | str, sep: str = "|") -> Column:
    """Category list from any of three spellings, decided row by row.

    ``a|b|c`` is split; a list of dicts (``[{'id': 1, 'name': 'A'}]``) gives the
    names; a list of strings (``['a', 'b']``) gives the strings. Names are
    stripped and lower-cased; NULL gives an empty list. The Python words None,
    True and False are read as their JSON counterparts.
    """
    none = F.array().cast("array<string>")
    quotes = {"allowSingleQuotes": "true"}

    # One-element transforms hold a text, so that each step is worked out once however often it is used.
    def from_json(text: Column) -> Column:
        for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
            text = F.regexp_replace(text, rf"(?<=[:,\[]\s{{0,9}}){word}(?=\s*[,}}\]])", json)
        dicts = lambda x: F.from_json(x, "array<struct<name:string>>", quotes)["name"]
        parsed = lambda x: F.when(x.rlike(r"^\[\s*\{"), dicts(x)).otherwise(F.from_json(x, "array<string>", quotes))
        return F.get(F.transform(F.array(text), parsed), F.lit(0))

    parsed = lambda x: F.when(x.isNull(), none).when(x.startswith("["), from_json(x)).otherwise(F.split(x, "\\" + sep))
    names = F.get(F.transform(F.array(strip(c)), parsed), F.lit(0))
    return F.transform(F.coalesce(names, none), lambda x: F.lower(strip(x)))
