"""Key index of an event log: per load, the least and greatest key and a Bloom filter.

A load's keys are dealt into parts of about ``KEYS_A_PART`` by hash; each part is one
row of the index (part, parts, n, low, high, words), so no row grows with the load.  The
filter has ``BITS_A_KEY`` bits a key and sets ``PROBES`` of them: a key that a load does
not hold passes with a chance of about 1 in a million.  What passes is only looked up
in vain; a key that is there always passes.

Building shuffles the keys once, by part, and sets the bits of a part (a bounded group)
with numpy; testing joins the new keys with the index rows of their parts in Spark's own
expressions.  NULL keys are not indexed: no load can hold them.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS_A_PART = 1 << 18
BITS_A_KEY = 32
PROBES = 12


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.hash(key), F.lit(parts)).cast("int")


def _bit(h: Column, bits: Column, probe: Column) -> Column:
    """Place of a key's ``probe``-th bit: two halves of its hash, combined (fits 64 bits for any probe)."""
    low, high = h.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(h, 33).bitwiseOR(F.lit(1))
    return (low + high * probe) % bits


def _filter_words(h: np.ndarray) -> np.ndarray:
    """The filter of a part's hashes as words of 64 bits (the bits :func:`_bit` names)."""
    bits = -(-len(h) * BITS_A_KEY // 64) * 64
    low, high = h & ((1 << 31) - 1), (h.view(np.uint64) >> np.uint64(33)).astype(np.int64) | 1
    flags = np.zeros(bits, bool)
    for i in range(PROBES):
        flags[(low + high * i) % bits] = True
    return np.packbits(flags, bitorder="little").view("<i8")


def build_index(rows: DataFrame, key: str) -> DataFrame:
    """The index of one load: one row a part."""
    keys = rows.select(F.col(key).alias("key")).where(F.col("key").isNotNull())
    parts = 1 << max(0, math.ceil(math.log2(max(1, keys.count()) / KEYS_A_PART)))
    # Hashes are taken after the shuffle: only keys move.
    dealt = keys.select(_part(F.col("key"), parts).alias("part"), "key").repartition("part").select(
        "part", F.xxhash64("key").alias("h"), "key")
    kind = rows.schema[key].dataType
    schema = T.StructType([T.StructField(name, of) for name, of in (
        ("part", T.IntegerType()), ("parts", T.IntegerType()), ("n", T.LongType()), ("low", kind), ("high", kind),
        ("words", T.ArrayType(T.LongType())))])

    def index_part(own: pa.Table) -> pa.Table:
        ends, words = pc.min_max(own["key"]), _filter_words(own["h"].to_numpy())
        one = lambda value: pa.array([value.as_py()], value.type)
        return pa.table({"part": own["part"].combine_chunks()[:1], "parts": pa.array([parts], pa.int32()),
                         "n": pa.array([own.num_rows], pa.int64()), "low": one(ends["min"]), "high": one(ends["max"]),
                         "words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words))})
    return dealt.groupBy("part").applyInArrow(index_part, schema)


# Copies of an index row, at most, among which a large batch's keys of its part are dealt.
MAX_DEALS = 16


def _passes(key: str) -> Column:
    """Whether a filter's row (low, high, words) lets a key (with its hash ``_h``) through."""
    bits = F.size("words").cast("long") * 64

    def held(i: Column) -> Column:
        at = _bit(F.col("_h"), bits, i)
        return F.getbit(F.get("words", F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1
    # Over the probes one by one, ended by the first bit that is not set.
    return (F.col(key) >= F.col("low")) & (F.col(key) <= F.col("high")) & F.forall(
        F.array(*[F.lit(i) for i in range(PROBES)]), held)


def _widths(index: DataFrame) -> list[int]:
    return [r["parts"] for r in index.select("parts").distinct().collect()]      # powers of two: a few


def _hashed(keys: DataFrame, key: str, parts: int) -> DataFrame:
    return keys.select(F.col(key)).where(F.col(key).isNotNull()).select(
        key, _part(F.col(key), parts).alias("part"), F.xxhash64(F.col(key)).alias("_h"))


def _dealt(keys: DataFrame, key: str, parts: int, deals: int, moved: bool) -> DataFrame:
    """Keys with part, deal and hash; those that are ``moved`` to the rows of their part go without the hash."""
    own = _hashed(keys, key, parts).withColumn("deal", F.pmod(F.shiftright("_h", 40), F.lit(deals)).cast("int"))
    if not moved:
        return own
    return own.drop("_h").repartition("part", "deal").withColumn("_h", F.xxhash64(F.col(key)))


def loads_that_may_hold(index: DataFrame, keys: DataFrame, key: str, *, broadcast_keys: bool = False) -> DataFrame:
    """Rows (load_id): the loads of ``index`` that may hold one of ``keys``.

    An index row looks through the keys of its part until one passes (a semi join), so no
    row of a filter is copied for a key.  ``broadcast_keys`` says there are few; else a
    part's keys are dealt among copies of its index rows if they are many.
    """
    found = None
    count = 0 if broadcast_keys else keys.count()
    for parts in _widths(index):
        deals = max(1, min(MAX_DEALS, math.ceil(count / (parts * 4 * KEYS_A_PART))))
        own = _dealt(keys, key, parts, deals, moved=not broadcast_keys)
        rows = index.where(F.col("parts") == parts).withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
        # Rows of both sides by name: the key stands on one side only.
        i, k = rows.alias("i"), (F.broadcast(own) if broadcast_keys else own).alias("k")
        met = (F.col("i.part") == F.col("k.part")) & (F.col("i.deal") == F.col("k.deal")) & _passes(key)
        some = i.join(k, met, "left_semi").select("load_id")
        found = some if found is None else found.unionByName(some)
    return index.select("load_id").where(F.lit(False)) if found is None else found.distinct()


def may_hold(index: DataFrame, keys: DataFrame, key: str, *, broadcast_keys: bool = False) -> DataFrame:
    """Rows (load_id, key): the ``keys`` each load of ``index`` (with its load_id) may hold.

    ``broadcast_keys`` says the caller has checked that there are few.
    """
    found = []
    for parts in _widths(index):
        own = _hashed(keys.select(key).distinct(), key, parts)
        met = index.where(F.col("parts") == parts).join(F.broadcast(own) if broadcast_keys else own, "part")
        found.append(met.where(_passes(key)).select("load_id", key))
    if not found:
        return index.select("load_id", F.lit(None).cast(keys.schema[key].dataType).alias(key)).where(F.lit(False))
    return reduce(DataFrame.unionByName, found)
