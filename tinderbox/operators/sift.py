"""A Bloom filter of wanted keys, tested where a store is scanned.

Joining a store of large rows with a few wanted keys shuffles the whole store. Here the keys are first folded into the bits
of one array, whose size is fixed by a parameter and not by the data; rows whose bits are not all set can't be wanted and stop at
the scan. A few others pass by chance, so the join that follows decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
EXPECTED = 400_000  # keys, at ten bits each: about one unwanted row in eighty passes


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def bloom_words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with one array of `bits` / 64 numbers, whose bits are those of the keys."""
    places = F.explode(F.array(*_places(F.col(key), bits))).alias("at")
    words = keys.where(F.col(key).isNotNull()).select(places).select(
        F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("mask")
    )
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    dense = words.unionByName(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda x: x["mask"]).alias("words"))


def sifted(store: DataFrame, key: str, wanted: DataFrame, expected: int = EXPECTED) -> DataFrame:
    """The rows of `store` whose key may be among those of `wanted`, which has a column of the same name.

    No wanted row is lost. `expected` is about how many keys are wanted; with many more, more rows pass
    that nobody wants. The filter of 400,000 keys takes half a megabyte. Null keys stop here.
    """
    bits = 1 << max(12, (10 * expected - 1).bit_length())
    words = bloom_words(wanted.select(key), key, bits).scalar()
    tests = [F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1 for at in _places(F.col(key), bits)]
    passes = F.col(key).isNotNull()
    for test in tests:
        passes = passes & test
    return store.where(passes)
