"""Column expressions that derive a binary class from vote columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def vote_sum(votes: Sequence[str]) -> Column:
    """Row sum over the vote columns; a missing vote counts as 0."""
    total = F.lit(0.0)
    for v in votes:
        total = total + F.coalesce(F.col(v).cast("double"), F.lit(0.0))
    return total


def any_vote(votes: Sequence[str]) -> Column:
    """1 if the vote sum is positive, else the (non-positive, maybe fractional) sum itself."""
    s = vote_sum(votes)
    return F.when(s > 0, F.lit(1.0)).otherwise(s)


def positional_votes(columns: Sequence[str], key: str | None = None) -> list[str]:
    """P5: the vote columns of a labelled file are all columns after the first (the text), whatever their names.

    A key column that was added by the reader is not a vote.
    """
    return [c for c in columns if c != key][1:]


def threshold_vote(votes: Sequence[str], min_votes: int = 2) -> Column:
    """1 if the truncated vote sum reaches ``min_votes`` (reference: ``int(sum) > 1``)."""
    return F.when(vote_sum(votes).cast("int") >= min_votes, F.lit(1)).otherwise(F.lit(0))
