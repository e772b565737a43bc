"""Column expressions over id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import PAD_ID


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def pad_right(ids: Column | str, length: Column | int, pad: int = PAD_ID) -> Column:
    """Right-pad with ``pad`` up to ``length`` (no-op for longer rows)."""
    n = F.lit(length) if isinstance(length, int) else length
    ids = _col(ids)
    return F.concat(ids, F.array_repeat(F.lit(pad).cast("long"), F.greatest(n - F.size(ids), F.lit(0))))


def truncate_keep_end(ids: Column | str, max_len: int) -> Column:
    """E3 (cut part): keep at most ``max_len`` ids; the last id (end marker) survives the cut."""
    ids = _col(ids)
    return F.when(F.size(ids) > max_len,
                  F.concat(F.slice(ids, 1, max_len - 1), F.slice(ids, -1, 1))).otherwise(ids)


def attention_mask(ids: Column | str) -> Column:
    """1 where the id is not padding, else 0."""
    return F.transform(_col(ids), lambda x: F.when(x != PAD_ID, F.lit(1)).otherwise(F.lit(0)))


def segment_ids(ids: Column | str) -> Column:
    """E5: all-zero segment ids for single-text examples."""
    return F.array_repeat(F.lit(0), F.size(_col(ids)))


def example_struct(input_ids: Column | str, token_type_ids: Column | str,
                   mask: Column | str) -> Column:
    """The three parallel arrays as one struct."""
    return F.struct(_col(input_ids).alias("input_ids"),
                    _col(token_type_ids).alias("token_type_ids"),
                    _col(mask).alias("attention_mask"))
