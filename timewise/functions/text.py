"""Text normal form as built-in column expressions (no Python worker).

ASCII values pass untouched and Latin ones go through two fold tables.  A
value with any other character is spelled out character by character:
alphabets by a table, Hangul by arithmetic on its syllables, Han characters by
their syllable.  The tables of the other scripts are built once by rule, from
the transliterator the JVM carries; Cyrillic and Greek letters have the usual
values of ASCII folding instead.  A letter or digit without any reading becomes
``u`` and its code point, so different values stay different.
"""
from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Letters whose ASCII form is more than one letter (transliteration
# must equal the usual ASCII folding of the reference's text cleaner).
MULTI_LETTER_FOLDS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "þ": "th", "Þ": "TH", "ĳ": "ij", "Ĳ": "IJ",
}
# One-letter folds that are not accent decompositions.
EXTRA_ONE_LETTER_FOLDS = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "Ð": "D", "ı": "i"}


def _accent_table() -> tuple[str, str]:
    """One-letter folds built by rule: every Latin-1 / Latin Extended-A letter
    whose canonical decomposition starts with an ASCII letter maps to it."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0180):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    for k, v in EXTRA_ONE_LETTER_FOLDS.items():
        if k not in src:
            src.append(k)
            dst.append(v)
    return "".join(src), "".join(dst)


ACCENT_SRC, ACCENT_DST = _accent_table()


def ascii_fold(c: Column | str) -> Column:
    """Fold accented letters to ASCII.  A value whose character count equals
    its UTF-8 byte count is pure ASCII and passes through untouched, so the
    fold tables are only consulted for the (rare) non-ASCII values."""
    c = F.col(c) if isinstance(c, str) else c
    folded = c
    for k, v in MULTI_LETTER_FOLDS.items():
        folded = F.replace(folded, F.lit(k), F.lit(v))
    folded = F.translate(folded, ACCENT_SRC, ACCENT_DST)
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(folded)


# The ASCII folding of Cyrillic (in alphabetical order, then the
# letters of single languages) and Greek letters.
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюя", (
    "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch \" y ' e iu ia").split())) | dict(zip(
    "ѐёђѓєѕіїјљњћќѝўџґ", "ie io dj gj ie dz i yi j lj nj tsh kj i u dzh g".split()))
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))

#: Code points that have a table entry: alphabets of the basic plane.
ALPHABETS = [(0x0180, 0x0E80), (0x10A0, 0x1100), (0x1C80, 0x2000), (0x2070, 0x20A0), (0x2460, 0x2500), (0x2C00, 0x2E00), (0x3041, 0x3100), (0xA640, 0xA800), (0xFB00, 0xFB50), (0xFF10, 0xFFA0)]
HAN = (0x4E00, 0xA000)
#: The parts of a Hangul syllable, in code point order.
HANGUL = (0xAC00, 0xD7A4)
LEADS = "g kk n d tt r m b pp s ss  j jj ch k t p h".split(" ")
VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split()
TAILS = " g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split(" ")


def _readings(chars: str) -> list[str]:
    """What the JVM's transliterator makes of each character; empty where it
    has none or there is no JVM."""
    spark = SparkSession.getActiveSession()
    plain = [unicodedata.normalize("NFKD", c) for c in chars]
    out = ["".join(x for x in p if not unicodedata.combining(x)) for p in plain]
    if spark is not None:
        try:
            said = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Any-Latin; Latin-ASCII").transliterate("\n".join(chars)).split("\n")
        except TypeError:                                  # the class is not on the class path
            said = out
        if len(said) == len(chars):
            out = ["".join(x for x in unicodedata.normalize("NFKD", s) if not unicodedata.combining(x)) for s in said]
    return [x if x.isascii() else "" for x in out]


def _folded(c: str) -> str:
    """The reading of one letter by the fixed tables, or its own."""
    low = "".join(x for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x)) if c.lower() not in CYRILLIC else c.lower()
    return "".join(CYRILLIC.get(x) or GREEK.get(x) or MULTI_LETTER_FOLDS.get(x) or EXTRA_ONE_LETTER_FOLDS.get(x) or (x if x.isascii() else "\0") for x in low)


@lru_cache(maxsize=1)
def script_tables() -> tuple[dict[str, str], list[str], str]:
    """(reading of every letter of an alphabet, syllables, for every Han
    character the character whose code is its syllable's number + 256)."""
    letters = [chr(cp) for lo, hi in ALPHABETS for cp in range(lo, hi) if unicodedata.category(chr(cp))[0] in "LMN"]
    table = {}
    for c, said in zip(letters, _readings("".join(letters))):
        own = _folded(c)
        table[c] = "" if unicodedata.category(c)[0] == "M" and not said else (own if own and "\0" not in own else said.lower().strip() or f"u{ord(c):x} ")
    han = [chr(cp) for cp in range(*HAN)]
    said = [x.lower().strip() or f"u{ord(c):x}" for c, x in zip(han, _readings("".join(han)))]
    syllables = sorted(set(said))
    number = {x: chr(256 + k) for k, x in enumerate(syllables)}
    return table, syllables, "".join(number[x] for x in said) if len(syllables) < 20_000 else ""


def spelled(c: Column) -> Column:
    """A value spelled out in ASCII, character by character."""
    table, syllables, han = script_tables()
    table = {**{k: v for k, v in zip(ACCENT_SRC, ACCENT_DST)}, **MULTI_LETTER_FOLDS, **table}
    source, readings = F.lit("".join(table)), F.split(F.lit("|".join(table.values())), r"\|")

    def letter(ch: Column) -> Column:
        cp, at = F.ascii(ch), F.instr(source, ch)
        within = lambda r: (cp >= r[0]) & (cp < r[1])                # noqa: E731
        k = cp - HANGUL[0]
        part = lambda names, i: F.element_at(F.array(*[F.lit(x) for x in names]), (i + 1).cast("int"))      # noqa: E731
        hangul = F.concat(part(LEADS, F.floor(k / 588)), part(VOWELS, F.floor(k % 588 / 28)), part(TAILS, k % 28))
        out = F.when(cp < 128, ch).when(within(HANGUL), hangul)
        if han:
            number = F.ascii(F.substring(F.lit(han), cp - HAN[0] + 1, F.lit(1))) - 255
            out = out.when(within(HAN), F.concat(F.element_at(F.split(F.lit("|".join(syllables)), r"\|"), number), F.lit(" ")))
        return (out.when(at > 0, F.element_at(readings, F.greatest(at, F.lit(1)))).when(ch.rlike(r"\p{M}"), "")
                .when(ch.rlike(r"[\p{L}\p{N}]"), F.concat(F.lit("u"), F.lower(F.hex(cp)), F.lit(" "))).otherwise(" "))

    return F.array_join(F.transform(F.split(c, ""), letter), "")


def clean_text(c: Column | str) -> Column:
    """Transliterate to ASCII, lower-case, non-alphanumerics to space,
    collapse runs of spaces, trim.  Nulls stay null.

    Replacing each maximal run of characters outside [a-z0-9] (spaces
    included) by one space does the replace and the collapse in a single
    regex pass (a third of the cost of two passes)."""
    c = F.col(c) if isinstance(c, str) else c
    folded = F.when(c.rlike(r"[^\x00-\u017F\u2000-\u206F]"), spelled(c)).otherwise(ascii_fold(c))
    return F.trim(F.regexp_replace(F.lower(folded), r"[^a-z0-9]+", " "))


def clean_text_py(s):
    """Driver-side twin of :func:`clean_text` for literal keys (mapping keys,
    level names).  Same folds, same order."""
    import re

    if s is None:
        return None
    s = str(s)
    if re.search(r"[^\x00-\u017F\u2000-\u206F]", s):
        table, syllables, han = script_tables()

        def letter(ch):
            cp = ord(ch)
            if HANGUL[0] <= cp < HANGUL[1]:
                k = cp - HANGUL[0]
                return LEADS[k // 588] + VOWELS[k % 588 // 28] + TAILS[k % 28]
            if HAN[0] <= cp < HAN[1] and han:
                return syllables[ord(han[cp - HAN[0]]) - 256] + " "
            if ch in table or cp < 0x180:
                return table.get(ch, ch)
            kind = unicodedata.category(ch)[0]
            return "" if kind == "M" else f"u{cp:x} " if kind in "LN" else " "

        s = "".join(map(letter, s))
    for k, v in MULTI_LETTER_FOLDS.items():
        s = s.replace(k, v)
    s = s.translate(str.maketrans(ACCENT_SRC, ACCENT_DST)).lower()
    return re.sub(r"[^a-z0-9]+", " ", s).strip(" ")


def clean_text_sql(expr: str) -> str:
    """The same normal form as DuckDB SQL text (used by oracle queries)."""
    e = expr
    for k, v in {**MULTI_LETTER_FOLDS, **EXTRA_ONE_LETTER_FOLDS}.items():
        e = f"replace({e}, '{k}', '{v}')"
    e = f"lower(strip_accents({e}))"
    e = f"regexp_replace({e}, '[^a-z0-9 ]+', ' ', 'g')"
    e = f"regexp_replace({e}, ' +', ' ', 'g')"
    return f"trim({e})"
