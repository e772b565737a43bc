"""T2 for other scripts: Greek, Cyrillic and Hangul beside Latin, without a chain of replacements."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import EXTRA_FOLDS, PUNCTUATION_FOLDS

# --- fixed values: small letters and their Latin spelling; parts of Hangul syllables in code order ---
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))
CYRILLIC = dict(zip("абвгдежзиклмнопрстуфхцчшщыэюя",
                    "a b v g d e zh z i k l m n o p r s t u f kh ts ch sh shch y e iu ia".split()))
CYRILLIC |= {"ъ": "", "ь": "'", "ё": "io", "й": "i", "є": "ie", "і": "i", "ї": "i", "ґ": "g", "ј": "j", "љ": "lj", "њ": "nj", "ђ": "dj", "џ": "dzh"}
INITIALS = ["g", "gg", "n", "d", "dd", "r", "m", "b", "bb", "s", "ss", "", "j", "jj", "c", "k", "t", "p", "h"]
MEDIALS = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split()
FINALS = ["", *"g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split()]
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
# --- end of fixed values -----------------------------------------------------------------------------

#: Latin-1 to Extended-B, Greek, Cyrillic, Extended Additional, Greek Extended
BLOCKS = ((0xC0, 0x250), (0x370, 0x400), (0x400, 0x530), (0x1E00, 0x2000))


def letter_table() -> dict[str, str]:
    """Every letter of BLOCKS that has an ASCII spelling, by decomposition and case from the fixed values."""
    small = GREEK | CYRILLIC
    out = dict(EXTRA_FOLDS | PUNCTUATION_FOLDS)
    for ch in (chr(cp) for block in BLOCKS for cp in range(*block)):
        if ch in out:
            continue
        low = ch.lower()
        spelled = small.get(low)
        if spelled is None:
            base = "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))
            spelled = "".join(c if c.isascii() else small.get(c, "") for c in base)
        if spelled:
            out[ch] = spelled if ch == low else spelled[0].upper() + spelled[1:]
    return out


def romanize(c: Column | str) -> Column:
    """Every character by its ASCII spelling.

    Spellings of one letter are one ``translate``; what is left outside
    ASCII is then looked up piece by piece, in one pass. Hangul syllables are spelled from their code point: initial, vowel and
    final are its quotients by 588 and 28. Characters without a spelling
    (and combining marks) go; ASCII texts are not touched; null stays null.
    """
    text = F.col(c) if isinstance(c, str) else c
    letters = sorted(letter_table().items())
    single = [kv for kv in letters if len(kv[1]) == 1]
    short = F.translate(text, "".join(k for k, _ in single), "".join(v for _, v in single))
    table = F.create_map(*[F.lit(x) for k, v in letters if len(v) > 1 for x in (k, v)])
    parts = [F.array(*[F.lit(p) for p in x]) for x in (INITIALS, MEDIALS, FINALS)]

    def hangul(ch):
        at = F.ascii(ch) - HANGUL_FIRST
        steps = (at / 588, F.pmod(at, F.lit(588)) / 28, F.pmod(at, F.lit(28)))
        return F.concat(*[F.get(p, F.floor(s).cast("int")) for p, s in zip(parts, steps)])

    def spelled(ch):
        syllable = (ch >= chr(HANGUL_FIRST)) & (ch <= chr(HANGUL_LAST))
        return F.when(ch <= "\x7f", ch).when(syllable, hangul(ch)).otherwise(F.coalesce(F.try_element_at(table, ch), F.lit("")))

    # runs of ASCII are one piece each, so only other characters are looked up one by one
    pieces = F.regexp_extract_all(short, F.lit(r"(?s)[\x00-\x7F]+|[^\x00-\x7F]"), 0)
    ascii_run = lambda p: F.when(F.ascii(p) < 128, p).otherwise(spelled(p))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(pieces, ascii_run), "")).otherwise(text)
