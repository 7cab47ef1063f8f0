"""Mixing sources to target weights by Sainte-Lague apportionment of token blocks.

Each source's documents are dealt by a seeded hash over shards and laid end to
end on each shard's token line in seeded order; lines are cut into blocks of
``block_tokens`` words.  Seats (blocks to take) go to sources by the highest
quotients target / (2 k + 1), and each source's seats to its shards in the same
way, which gives an integer quota per shard.  A shard with n blocks and quota q
takes all blocks q // n times and a run of q % n blocks from a seeded start (it
wraps around).  As documents lie in seeded order, the run is a random sample of
them, and at most a few documents of a shard are cut.  A block is at most
``BLOCK_TOKENS`` words and at most a hundredth of the smallest target (one word at
least), so that no source is too small for its seats: every source's take is within
one block a shard of its target.

Words, not texts, are shuffled for planning.  One task sees the totals of all
sources (one row each) or of one source's shards (``MAX_SHARDS`` rows at most).

Defined cases: a null text has size 0 and is never taken; a null source is a
source of its own, last in order; repeated rows are documents of their own;
an empty table gives an empty plan; extra columns stay as they are.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, packed, stage, word_count

BLOCK_TOKENS = 64
SHARD_TOKENS = 1 << 20
SHARD_ROWS = 1 << 14
MAX_SHARDS = 1 << 14      # of one source: beyond, shards grow instead
SEED = 20


def fill_targets(size: np.ndarray, weight: np.ndarray, total: float, limit: np.ndarray) -> np.ndarray:
    """Share ``total`` by weight; nothing exceeds its limit, the excess is shared again by weight."""
    target = np.zeros(len(size))
    rest, rest_w = float(total), float(weight.sum())
    order = np.argsort(limit / weight, kind="stable")
    for n, i in enumerate(order):
        if limit[i] > rest * weight[i] / rest_w:
            left = order[n:]
            target[left] = rest * weight[left] / rest_w
            break
        target[i] = limit[i]
        rest, rest_w = rest - limit[i], rest_w - weight[i]
    return target


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes / (2 k + 1), at most ``most`` each; ties go to the first.

    Rounding votes / d for any divisor d gives a prefix of the sequence of
    highest quotients; a divisor near the wanted number is searched, then single
    seats are added or taken back in order of quotient.
    """
    votes, most = votes.astype(float), np.where(votes > 0, most, 0).astype(np.int64)
    seats = int(min(seats, most.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)
    at = lambda d: np.minimum(np.floor(votes / d + 0.5), most).astype(np.int64)
    low, high = votes[votes > 0].min() / (2.0 * most.max() + 2), 2 * votes.max()
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if at(mid).sum() >= seats else (low, mid)
    got = at(high)
    over = at(low)
    got = over if abs(over.sum() - seats) < abs(got.sum() - seats) else got
    if got.sum() < seats:
        heap = [(-votes[i] / (2 * got[i] + 1), i) for i in np.flatnonzero(got < most)]
        heapq.heapify(heap)
        while got.sum() < seats:
            _, i = heapq.heappop(heap)
            got[i] += 1
            if got[i] < most[i]:
                heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    elif got.sum() > seats:
        heap = [(votes[i] / (2 * got[i] - 1), -i) for i in np.flatnonzero(got)]
        heapq.heapify(heap)
        while got.sum() > seats:
            i = -heapq.heappop(heap)[1]
            got[i] -= 1
            if got[i]:
                heapq.heappush(heap, (votes[i] / (2 * got[i] - 1), -i))
    return got


def _keys(source: Column) -> list[Column]:
    return [source.isNull().alias("_null"), F.coalesce(source, F.lit("")).alias("_name")]


def _sized(docs: DataFrame, seed: int) -> list[Column]:
    """Working columns of each document: source key, size, seeded place."""
    return [*_keys(docs["source"]), word_count(docs["text"]).alias("_size"),
            F.xxhash64(F.lit(seed), docs["doc_id"], docs["text"]).alias("_place")]


class Mix:
    """A plan: ``sources`` (target, block, seats, shards of each) and ``shards`` (quota of each)."""

    def __init__(self, sources: DataFrame, shards: DataFrame, seed: int):
        self.sources, self.shards, self.seed = sources, shards, seed

    def lay(self, sized: DataFrame) -> DataFrame:
        """Place documents (with the columns of ``_sized``) and work out what is taken of each.

        Adds ``_source_size, _target, _copies`` (whole takings) and the word ranges
        [_a1, _b1), [_a2, _b2) of a further, partial taking.
        """
        block = F.col("_block")
        placed = (sized.join(self.sources, ["_null", "_name"])
                  .withColumn("_shard", F.pmod("_place", "_n_shards"))
                  .join(self.shards, ["_null", "_name", "_shard"]))
        line = (Window.partitionBy("_null", "_name", "_shard").orderBy("_place", "_size")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        end = F.sum("_size").over(line)
        first, n, rest = F.col("_first"), F.col("_blocks"), F.col("_rest")
        laid = placed.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_size"))
        part = lambda lo, hi: (F.greatest(F.col("_start"), lo), F.least(F.col("_end"), hi))
        (a1, b1), (a2, b2) = (part(F.lit(0), F.greatest(first + rest - n, F.lit(0)) * block),
                              part(first * block, F.least(first + rest, n) * block))
        at = lambda x: x - F.col("_start")
        return laid.withColumns({"_a1": at(a1), "_b1": F.greatest(at(a1), at(b1)),
                                 "_a2": at(a2), "_b2": F.greatest(at(a2), at(b2))})


def plan_mix(docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_copies: int = 2,
             block_tokens: int | None = None, shard_tokens: int = SHARD_TOKENS, seed: int = SEED
             ) -> tuple[Mix, DataFrame]:
    """Apportion the mix; returns it with the staged sizes (doc_id, source and working columns).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` of all words; a source's target stops at ``max_copies`` times its size.
    ``block_tokens`` fixes the block (None: as the module says).
    """
    sized = stage(docs.select(docs["doc_id"], docs["source"], *_sized(docs, seed)), "mix-sizes")

    def shares(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_null", "_name"], kind="stable", ignore_index=True)
        size = rows["_source_size"].to_numpy()
        weight = np.resize(np.asarray(weights, float), len(rows))
        target = fill_targets(size, weight, share * size.sum(), max_copies * size.astype(float))
        some = target[target > 0]
        block = block_tokens or int(np.clip(some.min() // 100 if len(some) else 1, 1, BLOCK_TOKENS))
        seats = sainte_lague(target, round(target.sum() / block), max_copies * -(-size // block))
        wanted = np.maximum(-(-size // shard_tokens), -(-rows["_rows"].to_numpy() // SHARD_ROWS))
        return rows.assign(_target=target, _block=block, _seats=seats, _n_shards=np.clip(wanted, 1, MAX_SHARDS))

    totals = sized.groupBy("_null", "_name").agg(F.sum("_size").alias("_source_size"), F.count("*").alias("_rows"))
    sources = stage(totals.groupBy(F.lit("all")).applyInPandas(
        shares, "_null boolean, _name string, _source_size long, _rows long, _target double, _block long,"
                " _seats long, _n_shards long").drop("_rows"), "mix-sources")

    def quotas(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_shard", ignore_index=True)
        blocks = -(-rows["_tokens"].to_numpy() // rows["_block"].to_numpy())
        quota = sainte_lague(rows["_tokens"].to_numpy(), int(rows["_seats"].iloc[0]), max_copies * blocks)
        some = np.maximum(blocks, 1)
        return rows.assign(_blocks=blocks, _quota=quota, _copies=quota // some, _rest=quota % some)

    tokens = (sized.join(sources, ["_null", "_name"])
              .groupBy("_null", "_name", F.pmod("_place", "_n_shards").alias("_shard"), "_seats", "_block")
              .agg(F.sum("_size").alias("_tokens")))
    shards = (tokens.groupBy("_null", "_name").applyInPandas(
        quotas, "_null boolean, _name string, _shard long, _seats long, _block long, _tokens long, _blocks long, _quota long,"
                " _copies long, _rest long")
        .select("_null", "_name", "_shard", "_blocks", "_quota", "_copies", "_rest",
                F.pmod(F.xxhash64(F.lit(seed), "_null", "_name", "_shard"),
                       F.greatest("_blocks", F.lit(1))).alias("_first")))
    return Mix(sources.drop("_seats"), stage(shards, "mix-quotas"), seed), sized


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, taken."""
    mix, sized = plan_mix(docs, **options)
    laid = mix.lay(sized)
    taken = (F.col("_copies") * F.col("_size") + F.col("_b1") - F.col("_a1") + F.col("_b2") - F.col("_a2"))
    return laid.select("doc_id", "source", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                       F.col("_target").alias("target"), taken.cast("long").alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: a row for each taking of a document, with the columns of ``docs``.

    A partial taking holds the words of its ranges with the white space between
    them; ``n_chars``, if there, is that of the new text.
    """
    mix, _ = plan_mix(docs, **options)
    laid = mix.lay(docs.select(packed(docs).alias("_row"), *_sized(docs, mix.seed)))
    text = F.col("_row.text")
    pieces = F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = lambda a, b: F.rtrim(F.array_join(F.slice(pieces, (a + 1).cast("int"), (b - a).cast("int")), ""))
    span1, span2 = F.col("_b1") - F.col("_a1"), F.col("_b2") - F.col("_a2")
    some = lambda a, b: F.when(b > a, F.array(cut(a, b))).otherwise(F.array().cast("array<string>"))
    partial = (F.when(span1 + span2 == 0, F.array().cast("array<string>"))
               .when(span1 + span2 == F.col("_size"), F.array(text))
               .otherwise(F.concat(some(F.col("_a1"), F.col("_b1")), some(F.col("_a2"), F.col("_b2")))))
    whole = F.when(F.col("_size") > 0, F.array_repeat(text, F.col("_copies").cast("int"))).otherwise(
        F.array().cast("array<string>"))
    rows = laid.select("_row", F.explode(F.concat(whole, partial)).alias("_text"))
    return rows.select(*[
        F.col("_text").alias(c) if c == "text" else F.length("_text").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"_row.`{c}`") for c in docs.columns])
