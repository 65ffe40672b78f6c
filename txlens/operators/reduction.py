"""Filtering a large table by the keys of another one before they are joined.

A Bloom filter of one hash function, kept as a table of 64-bit words: the keys of the smaller
side set bits, the words are broadcast, and rows of the larger side whose bit is not set are
dropped where they are read. Rows that pass by chance go with the join that follows.
"""

from pyspark.sql import functions as F

from txlens.params import BROADCAST_ROWS
from txlens.staging import stage

#: Bits for each key; one in so many of the other rows passes by chance.
BITS_PER_KEY = 16


def _place(key, bits):
    """The bit of a key: its word and the place in it."""
    bit = F.pmod(F.xxhash64(*key), F.lit(bits))
    return F.shiftright(bit, 6), bit.bitwiseAND(63).cast("int")


def keep_possible(df, keys, *key, words=BROADCAST_ROWS, bits_per_key=BITS_PER_KEY):
    """The rows of ``df`` whose key may be among those of ``keys``; none of those is lost.

    ``keys`` should be a staged table: it is read to be counted, to set the bits, and by the
    caller's join. What is broadcast has at most ``words`` rows of two numbers, whatever the
    size of ``keys``. Where that leaves fewer than two bits for a key the filter would pass
    most rows, and ``df`` comes back as it is. Rows with a null in the key are dropped.
    """
    rows = keys.count()
    bits = min(max(rows * bits_per_key, 64), 64 * words)
    if bits < 2 * rows:
        return df
    word, place = _place(key, bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    table = stage(keys.dropna(subset=list(key)).select(word.alias("_word"), one.alias("_one"))
                  .groupBy("_word").agg(F.bit_or("_one").alias("_bits")))
    own, at = _place(key, bits)
    held = df.dropna(subset=list(key)).withColumn("_own", own).join(F.broadcast(table), F.col("_own") == F.col("_word"))
    return held.where(F.getbit(F.col("_bits"), at) == 1).select(*df.columns)
