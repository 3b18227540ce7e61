"""NOT IN against a large set, with most rows kept where they are.

An anti join shuffles every row of the left side, though most rows of a NOT IN
that is worth having are in no set at all. A bitmap over the set's hashed keys,
built by an ordinary aggregate, rules those out: a row whose bit is not set is
certainly outside and skips the shuffle; the others (members, and the few that
share a bit with one) go to the exact anti join.

The bitmap is a table of 64-bit words, at most ``most_bits / 64`` of them whatever
the set's size, so broadcasting it is bounded (2^27 bits: two million words, 32
MB). With 16 bits a key, 6 rows of 100 go to the exact join needlessly; a set
of over half as many keys as there are bits would rule out too little, and all
rows go to the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.operators.anti import Facts, not_in

_WORD, _BIT, _MASK, _SET = "_settlebook_word", "_settlebook_bit", "_settlebook_mask", "_settlebook_member"  # names that no input column has
WORD = 64


def bits_for(rows: int, most_bits: int, per_key: int = 16) -> int:
    """A power of two: ``per_key`` bits a key, within ``most_bits``; 0 if a bitmap would not pay."""
    bits = 1 << max(10, (per_key * max(rows, 1) - 1).bit_length())
    bits = min(bits, most_bits)
    return bits if 2 * rows <= bits else 0


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.floor(at / WORD).cast("bigint"), F.pmod(at, F.lit(WORD)).cast("int")


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """``_word, _mask``: the set bits of the keys' hashes. A partial aggregate of
    fixed-width values: map tasks send at most one row per word."""
    word, bit = _place(F.col(key), bits)
    return (keys.where(F.col(key).isNotNull()).select(word.alias(_WORD), bit.alias(_BIT))
                .groupBy(_WORD).agg(F.bit_or(F.expr(f"shiftleft(1L, {_BIT})")).alias(_MASK)))


def split_by_bitmap(df: DataFrame, key: str, keyset: DataFrame, key_col: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` that are certainly not in the set, and the others."""
    word, bit = _place(F.col(key), bits)
    words = F.broadcast(bitmap(keyset, key_col, bits))
    probed = df.withColumn(_WORD, word).withColumn(_BIT, bit).join(words, _WORD, "left")
    hit = F.coalesce(F.expr(f"(shiftright({_MASK}, {_BIT}) & 1L) = 1L"), F.lit(False))
    extra = (_WORD, _BIT, _MASK)
    return probed.where(~hit).drop(*extra), probed.where(hit).drop(*extra)


def split_by_keys(df: DataFrame, key: str, keyset: DataFrame, key_col: str, most_bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """:func:`split_by_bitmap` with as many bits as the set's rows ask for; where
    a bitmap would not pay, all rows are among the others. ``keyset`` should be
    a written table: it is read to be counted and to set the bits."""
    bits = bits_for(keyset.count(), most_bits)
    return split_by_bitmap(df, key, keyset, key_col, bits) if bits else (df.where(F.lit(False)), df)


def not_in_split(df: DataFrame, key: str, keyset: DataFrame, key_col: str, facts: Facts, most_bits: int = 1 << 27) -> DataFrame:
    """:func:`~settlebook.operators.not_in` by way of a bitmap; the same rows.
    ``facts`` are the set's (``set_facts``): rows may repeat keys."""
    kinds = df.schema[key].dataType, keyset.schema[key_col].dataType
    bits = bits_for(facts.rows, most_bits) if kinds[0] == kinds[1] else 0
    if facts.nulls or not facts.rows or not bits:
        return not_in(df, key, keyset, key_col, facts=facts)
    outside, others = split_by_bitmap(df.where(F.col(key).isNotNull()), key, keyset, key_col, bits)
    members = keyset.select(F.col(key_col).alias(_SET)).distinct()
    return outside.unionByName(others.join(members, F.col(key) == F.col(_SET), "left_anti"))
