"""A bitmap of key hashes: rows that match none of a frame's keys are told apart without a shuffle.

A key sets one bit, at the leading bits of its hash. The bitmap is a frame with a
row for each 64-bit word that has a bit set, so it is built by partial aggregation
and has at most ``2 ** (MAX_BITS - 6)`` rows of two longs, whatever the number of
keys: small enough to be sent to all executors. A row whose bit isn't set has no
match; a row whose bit is set may have one. More keys than bits set nearly all
bits, which tells fewer rows apart but never a wrong one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.names import col
from tablesync.operators.predicates import conjunction

MIN_BITS, MAX_BITS = 16, 27  # exponents; the greatest bitmap has 2 million rows
_BITS_PER_KEY = 16
_WORD, _SET = "__word", "__set"


def bits_for(n_keys: int) -> int:
    """Exponent of the number of bits for about ``n_keys`` keys: sixteen bits or more each, within the bounds."""
    return min(max((_BITS_PER_KEY * n_keys).bit_length(), MIN_BITS), MAX_BITS)


def _position(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[col(k) for k in keys]), 64 - bits)


def key_words(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """The bitmap of the keys of ``df``. Keys with a null, which match nothing, set no bit."""
    at = _position(keys, bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    has_keys = conjunction(*[col(k).isNotNull() for k in keys])
    marked = df.where(has_keys).select(F.shiftright(at, 6).alias(_WORD), bit.alias(_SET))
    return marked.groupBy(_WORD).agg(F.bit_or(_SET).alias(_SET))


@dataclass(frozen=True)
class KeyFilter:
    """``words`` as ``key_words`` gives them, of ``2 ** bits`` bits.

    The frames it is applied to need keys of the very types of those it was built of.
    """

    words: DataFrame
    keys: Sequence[str]
    bits: int

    def _joined(self, df: DataFrame, how: str) -> DataFrame:
        at = _position(self.keys, self.bits)
        is_set = F.bit_get(F.col(_SET), at.bitwiseAND(F.lit(63)).cast("int")) == 1
        # At most 2 ** (MAX_BITS - 6) rows.
        return df.join(F.broadcast(self.words), (F.shiftright(at, 6) == F.col(_WORD)) & is_set, how)

    def possible(self, df: DataFrame) -> DataFrame:
        """Rows that may match a key."""
        return self._joined(df, "left_semi")

    def impossible(self, df: DataFrame) -> DataFrame:
        """All others."""
        return self._joined(df, "left_anti")
