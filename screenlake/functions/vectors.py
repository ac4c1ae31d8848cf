"""Fixed-width vector columns: parse, format, binarise, pack to 64-bit words, Tanimoto.

Vectors are ``array<float>``; bit vectors are packed into ``array<bigint>`` (64 bits
per word) so similarity is ``bit_count`` over a handful of longs instead of a loop
over thousands of floats.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .maths import as_col


def parse_text_vector(c: Column | str, sep: str = ",") -> Column:
    """'0, 1, 0.5' -> array<float>; blanks around separators allowed, bad tokens -> NULL element."""
    parts = F.split(as_col(c), sep)
    return F.transform(parts, lambda x: F.trim(x).try_cast("float"))


def format_text_vector(c: Column | str, sep: str = ", ") -> Column:
    return F.array_join(F.transform(as_col(c), lambda x: x.cast("string")), sep)


def binarize(c: Column | str) -> Column:
    """Counts -> presence bits (x > 0 -> 1)."""
    return F.transform(as_col(c), lambda x: F.when(x > 0, 1).otherwise(0))


def pack_bits(bits: Column | str) -> Column:
    """array<int 0/1> -> array<bigint>; bit i of word w is element 64*w + i."""
    bits = as_col(bits)
    n = F.size(bits)
    n_words = F.floor((n + 63) / 64).cast("int")

    def word(w):
        lo = w * 64
        hi = F.least(lo + 63, n - 1)
        return F.aggregate(
            F.sequence(lo, hi), F.lit(0).cast("bigint"),
            lambda acc, i: acc.bitwiseOR(F.call_function("shiftleft", F.get(bits, i).cast("bigint"), i - lo)))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n_words - 1), word)) \
            .otherwise(F.array().cast("array<bigint>"))


def popcount(packed: Column | str) -> Column:
    return F.aggregate(as_col(packed), F.lit(0), lambda acc, x: acc + F.bit_count(x))


def intersection_count(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(as_col(a), as_col(b), lambda x, y: F.bit_count(x.bitwiseAND(y))),
                       F.lit(0), lambda acc, x: acc + x)


def tanimoto_from_counts(inter: Column, pop_a: Column, pop_b: Column) -> Column:
    """|a ∧ b| / |a ∨ b|; 0.0 when both are empty."""
    union = pop_a + pop_b - inter
    return F.when(union == 0, F.lit(0.0)).otherwise(inter.cast("double") / union.cast("double"))


def tanimoto(a: Column | str, b: Column | str) -> Column:
    inter = intersection_count(a, b)
    return tanimoto_from_counts(inter, popcount(a), popcount(b))
