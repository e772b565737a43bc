"""Column -> Column text functions.

All of them are built-in Spark expressions and work unchanged on batch and
streaming frames. Scalar ones are generated code; ``filter`` and
``transform`` over token arrays are interpreted inside the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import LEMMAS, PUNCTUATION, STOP_WORDS, accent_folds, fold_word

# Tokens: a run of word characters, or any single non-space symbol.
TOKEN_PATTERN = r"[a-z0-9_]+|[^a-z0-9_\s]"
# Word-only tokens (``\b\w+\b`` on folded, lower-cased text).
WORD_PATTERN = r"[a-z0-9_]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_punctuation(c: Column | str) -> Column:
    """Delete every ASCII punctuation character."""
    return F.translate(_col(c), PUNCTUATION, "")


def fold_accents(c: Column | str) -> Column:
    """Fold to ASCII (``ação`` -> ``acao``, ``ß`` -> ``ss``, curly quotes to straight ones).

    Covers Latin up to U+1EFF and General Punctuation; combining marks go,
    so decomposed letters fold like composed ones, and what is left
    outside ASCII is deleted. ASCII texts skip all of it.
    """
    src, dst, multi = accent_folds()
    text = _col(c)
    out = F.translate(text, src, dst)
    for k, v in multi:
        out = F.replace(out, F.lit(k), F.lit(v))
    out = F.regexp_replace(out, r"[^\x00-\x7F]", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), out).otherwise(text)


def lowercase(c: Column | str) -> Column:
    """T3."""
    return F.lower(_col(c))


def preprocess(c: Column | str) -> Column:
    """T4: punctuation removal, then accent folding, then lower case.

    A null text becomes the empty string so that downstream token arrays
    are empty rather than null.
    """
    return lowercase(fold_accents(strip_punctuation(F.coalesce(_col(c), F.lit("")))))


def normalise(c: Column | str) -> Column:
    """Fold + lower without deleting punctuation (input of the TF-IDF tokenizer)."""
    return lowercase(fold_accents(F.coalesce(_col(c), F.lit(""))))


def tokenize(c: Column | str) -> Column:
    """T5: words and single punctuation marks as separate tokens."""
    return F.regexp_extract_all(_col(c), F.lit(TOKEN_PATTERN), 0)


def word_tokens(c: Column | str) -> Column:
    """Word tokens only."""
    return F.regexp_extract_all(_col(c), F.lit(WORD_PATTERN), 0)


def stop_word_list(words: Iterable[str] | None = None, fold_list: bool = False) -> list[str]:
    ws = list(STOP_WORDS if words is None else words)
    if fold_list:
        ws = [fold_word(w).lower() for w in ws]
    return sorted(set(ws))


def remove_stop_words(tokens: Column | str, words: Iterable[str] | None = None,
                      fold_list: bool = False) -> Column:
    """Drop stop words from a token array (order kept)."""
    lst = stop_word_list(words, fold_list)
    return F.filter(_col(tokens), lambda t: ~t.isin(lst))


def lemmatize(tokens: Column | str, lemmas: Iterable[tuple[str, str]] | None = None) -> Column:
    """Map each token through a lemma lexicon, identity when unknown."""
    pairs = list(LEMMAS if lemmas is None else lemmas)
    lex = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    return F.transform(_col(tokens), lambda t: F.coalesce(F.try_element_at(lex, t), t))


def join_tokens(tokens: Column | str, sep: str = " ") -> Column:
    """T8c."""
    return F.array_join(_col(tokens), sep)


def decode_utf8(c: Column | str) -> Column:
    """Bytes -> string."""
    return F.decode(_col(c), "UTF-8")


def format3(c: Column | str) -> Column:
    """Number formatted with three decimals."""
    return F.format_string("%.3f", _col(c))
