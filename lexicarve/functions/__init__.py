"""Column -> Column building blocks."""

from .arrays import attention_mask, example_struct, pad_right, segment_ids, truncate_keep_end
from .labels import any_vote, threshold_vote, vote_sum
from .text import (decode_utf8, fold_accents, format3, join_tokens, lemmatize, lowercase,
                   normalise, preprocess, remove_stop_words, strip_punctuation, tokenize,
                   word_tokens)

__all__ = [
    "attention_mask", "example_struct", "pad_right", "segment_ids", "truncate_keep_end",
    "any_vote", "threshold_vote", "vote_sum",
    "decode_utf8", "fold_accents", "format3", "join_tokens", "lemmatize", "lowercase",
    "normalise", "preprocess", "remove_stop_words", "strip_punctuation", "tokenize",
    "word_tokens",
]
