"""A Bloom filter over strings as one binary value, built and asked by SQL functions.

It keeps rows that cannot matter out of a shuffle: a string that was put in is always said to be in, another one rarely.  Each
string sets two bits; there are 16 bits for each, up to ``MOST_BITS`` (256 KB, sent with the plan), beyond which the
filter lets more through and stays right.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one value of ``bitmap_construct_agg``.
WORD = 32_768
MOST_BITS = 1 << 21
SEEDS = (11, 23)


def _place(value: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(bits).cast("bigint"))


@dataclass(frozen=True)
class Bloom:
    data: bytes
    bits: int

    def may_hold(self, value: Column) -> Column:
        """False only for what was not put in."""

        def bit(seed: int) -> Column:
            place = _place(value, seed, self.bits)
            byte = F.conv(F.hex(F.substring(F.lit(self.data), F.call_function("div", place, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.call_function("shiftright", byte, (place % 8).cast("int")) % 2 == 1

        return bit(SEEDS[0]) & bit(SEEDS[1])


def build(values: DataFrame, column: str) -> Bloom:
    """A filter of the values of a column; nulls are not put in.  The driver gets its words, 4 KB each."""
    values = values.select(F.col(f"`{column}`").alias("v")).where("v is not null")
    many = values.agg(F.approx_count_distinct("v")).first()[0]
    bits = min(MOST_BITS, -(-max(many, 1) * 16 // WORD) * WORD)
    places = values.select(F.explode(F.array(*(_place(F.col("v"), s, bits) for s in SEEDS))).alias("p"))
    words = places.groupBy(F.call_function("div", F.col("p"), F.lit(WORD)).alias("w")).agg(F.bitmap_construct_agg(F.col("p") % WORD).alias("bits"))
    data = bytearray(bits // 8)
    for r in words.collect():
        data[r["w"] * WORD // 8 : (r["w"] + 1) * WORD // 8] = r["bits"]
    return Bloom(bytes(data), bits)
