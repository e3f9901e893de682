"""A Bloom filter of keys in plain columns: built by an aggregate, tested inside a scan.

The filter has one false positive in a hundred or so at ten bits a key, and never a false negative. It is a scalar
subquery, so it is built once for a query and reaches every task with the plan; its size is the caller's choice and bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
BITS_PER_KEY = 10
#: 64-bit words of the smallest and of the largest filter; the largest is 1 MB.
LEAST_WORDS, MOST_WORDS = 16, 131_072


def words_for(keys: int) -> int:
    """Words of a filter for so many keys, a power of two. Beyond MOST_WORDS, false positives become more."""
    words = LEAST_WORDS
    while words < MOST_WORDS and 64 * words < BITS_PER_KEY * keys:
        words *= 2
    return words


def _places(key: Column, words: int) -> list[Column]:
    """The bits of a key. words is a power of two, so masks take remainders."""
    return [F.xxhash64(F.lit(f"bloom-{k}"), key).bitwiseAND(F.lit(64 * words - 1)) for k in range(HASHES)]


def _mask(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def bloom_filter(df: DataFrame, key: str, words: int) -> Column:
    """The words of the filter of a column's values, nulls left out, as a scalar subquery.

    Keys are reduced to words map-side; what is put in order is `words` rows, whatever the number of keys.
    """
    places = df.filter(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), words))).alias("place"))
    word = F.shiftright("place", 6).alias("word")
    own = places.groupBy(word).agg(F.bit_or(_mask(F.col("place"))).alias("bits"))
    every = df.sparkSession.range(words).select(F.col("id").alias("word")).join(own, "word", "left")
    filled = F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    return every.agg(F.sort_array(F.collect_list(filled))["bits"].alias("words")).scalar()


def may_contain(filter_words: Column, key: Column, words: int) -> Column:
    """Whether the key may be among those of the filter; false only if it is not. A null key is in no filter."""
    found = F.lit(True)
    for place in _places(key, words):
        bits = F.element_at(filter_words, (F.shiftright(place, 6) + 1).cast("int"))
        found = found & (bits.bitwiseAND(_mask(place)) != 0)
    return key.isNotNull() & found
