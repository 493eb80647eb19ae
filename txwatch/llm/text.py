"""Small helpers shared by the text operators: column expressions, hashing and a fixed-size filter.

Conventions of every operator in this package, unless its docstring says otherwise: a null text is an empty
text; a null key is an ordinary value; repeated input rows give repeated output rows; other columns of the
input are neither read nor kept, so their names cannot clash; an empty table gives an empty result.

Joins of tables that grow with the corpus carry a merge hint in `near`, `graph`, `decontaminate` and `secrets`. Spark
counts an array as one element, an explode as no more rows and a stored column by its compressed file, so a table that
it takes for 10 MB, and would send through the driver, can be a hundred times that.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that parts words: space and the bytes 09 to 0D.
WHITE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"

U64 = np.uint64


def raw(column: str = "text") -> Column:
    """The text's UTF-8 bytes; null becomes no bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (multiply and shift)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class FixedFilter:
    """A set of 64-bit tokens as two probes into a bit field whose size does not depend on the data.

    `of` gathers it by a bitwise-or aggregate; at most 2**log2_bits / 64 words reach the driver. False
    positives only let more rows into the join behind the filter, so results do not depend on its size.
    """

    def __init__(self, words: np.ndarray, log2_bits: int):
        self.words, self.log2_bits = words, log2_bits

    @classmethod
    def of(cls, tokens: DataFrame, column: str, log2_bits: int = 24) -> FixedFilter:
        mask = (1 << log2_bits) - 1
        probes = F.array(F.col(column).bitwiseAND(F.lit(mask)), F.shiftrightunsigned(column, 64 - log2_bits))
        found = (
            tokens.select(F.explode(probes).alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
            .toArrow()
        )
        words = np.zeros(1 << (log2_bits - 6), dtype=U64)
        words[found["word"].to_numpy()] = found["bits"].to_numpy().view(U64)
        return cls(words, log2_bits)

    def has(self, tokens: np.ndarray) -> np.ndarray:
        low = tokens & U64((1 << self.log2_bits) - 1)
        high = tokens >> U64(64 - self.log2_bits)
        one, six, rest = U64(1), U64(6), U64(63)
        return ((self.words[low >> six] >> (low & rest)) & (self.words[high >> six] >> (high & rest)) & one) > 0
