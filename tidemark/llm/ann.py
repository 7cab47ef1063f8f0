"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``SAMPLE`` distinct vectors, those with the smallest hash)
the graph of nearest neighbours is cut into balanced parts by recursive
bisection: the graph's slowest-mixing direction splits each piece at its median.
A softmax classifier learns the parts from the vectors.  It then gives every
vector of the table its part, and routes each query to its most probable parts
until they hold ``mass`` of the probability and k + 1 candidates; ``mass`` is the
least that finds ``RECALL`` of the sample's neighbours of vectors that neither the
graph nor the classifier has seen.  Candidates are scored exactly.

Equal vectors are one candidate that carries its k + 1 smallest ids, which is
all that any query can return of them, and equal queries are searched once: a
vector that makes up a third of the table costs no more than another.  Parts are
cut into chunks of bounded size for the scoring tasks.

Defined cases: vectors that are null, zero or hold null or non-finite components
take no part, as candidates or queries, nor do those of another length than most
of the sample's; ids that are null take no part; repeated rows are one
candidate; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

SAMPLE = 4096
NEIGHBOURS = 10
PART_SAMPLE = 64          # sample vectors a part holds
RECALL = 0.98
CHUNK = 4096


def _distinct(rows: DataFrame, ids: int) -> DataFrame:
    """(vec, ids): each distinct vector as bytes of doubles, and its smallest ids in order."""
    def keep(sums: dict[bytes, list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"vec": pa.array(list(sums), pa.binary()),
                                           "ids": pa.array([sorted(set(v))[:ids] for v in sums.values()], pa.list_(pa.int64()))})

    def trim(sums: dict[bytes, list[int]], v: bytes, more: list[int]) -> None:
        have = sums.setdefault(v, [])
        have += more
        if len(have) > 8 * ids:
            sums[v] = sorted(set(have))[:ids]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0     # no negative zero
                if len(x) and np.isfinite(x).all() and x.any():
                    trim(sums, x.tobytes(), [i])
            yield keep(sums)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by vector: only the last one can go on in the next batch.
        last: dict[bytes, list[int]] = {}
        for batch in batches:
            for v, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if v not in last and len(last) > 1024:
                    yield keep(last)
                    last = {}
                trim(last, v, i)
        yield keep(last)
    kind = "vec binary, ids array<long>"
    some = rows.mapInArrow(read, kind)
    return some.repartition("vec").sortWithinPartitions("vec").mapInArrow(merge, kind)


class Partitioner:
    """Parts of the sample's neighbour graph, and the classifier that stands for them."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.weights, self.bias = np.zeros((sample.shape[1], 1)), np.zeros(1)
        self.mass, self.scale = 1.0, 1.0
        if parts < 2:
            return
        self.scale = 1 / np.sqrt((sample ** 2).sum(1).mean())
        near = np.empty((len(sample), NEIGHBOURS), int)
        for a in range(0, len(sample), 256):        # a block of rows at a time: the driver holds no square matrix
            score = sample[a:a + 256] @ sample.T
            score[np.arange(len(score)), np.arange(a, a + len(score))] = -np.inf
            near[a:a + 256] = np.argpartition(-score, NEIGHBOURS, 1)[:, :NEIGHBOURS]
        pairs = np.column_stack([np.repeat(np.arange(len(sample)), NEIGHBOURS), near.ravel()])
        # Every fifth vector is held out of the graph and the classifier, and tells how well they do.
        out = np.arange(len(sample)) % 5 == 4
        place = np.cumsum(~out) - 1
        pairs = place[pairs[~out[pairs].any(1)]]
        label = self._bisect(np.unique(np.vstack([pairs, pairs[:, ::-1]]), axis=0), int((~out).sum()), parts)
        self._learn(sample[~out] * self.scale, label, parts)
        self._calibrate(sample, out, near[out], parts)

    @staticmethod
    def _bisect(edges: np.ndarray, size: int, parts: int) -> np.ndarray:
        """The part of each vertex of a graph given as its edges, each in both directions."""
        label, rng = np.zeros(size, int), np.random.default_rng(0)
        work = [(np.arange(size), edges, 0, parts)]
        while work:
            rows, edges, first, n = work.pop()      # edges hold places in rows
            if n == 1:
                label[rows] = first
                continue
            i, j = edges[:, 0], edges[:, 1]
            into = lambda x: np.bincount(i, x[j], len(rows))  # noqa: B023, E731  the neighbours' sum
            degree = into(np.ones(len(rows)))
            root = np.sqrt(degree + 1e-3)
            top = root / np.linalg.norm(root)
            x = rng.standard_normal(len(rows))
            for _ in range(60):             # the second direction of the lazy walk
                x = x - top * (top @ x)
                x = into(x / root) / root + x
                x /= np.linalg.norm(x)
            order, cut = np.argsort(x, kind="stable"), len(rows) * (n // 2) // n
            low = np.zeros(len(rows), bool)
            low[order[:cut]] = True
            for _ in range(4):              # swap the vertices that gain most by changing sides, in equal numbers
                pull = 2 * into(low.astype(float)) - degree     # neighbours on the low side less those on the other
                gain = np.where(low, -pull, pull)
                a, b = np.flatnonzero(low), np.flatnonzero(~low)
                a, b = a[np.argsort(-gain[a])], b[np.argsort(-gain[b])]
                m = min(len(a), len(b))
                swaps = (gain[a[:m]] + gain[b[:m]] > 2).nonzero()[0][:max(1, m // 10)]
                if not len(swaps):
                    break
                low[a[swaps]], low[b[swaps]] = False, True
            for side, at, m in ((low, first, n // 2), (~low, first + n // 2, n - n // 2)):
                place = np.cumsum(side) - 1
                work.append((rows[side], place[edges[side[i] & side[j]]], at, m))
        return label

    def _learn(self, x: np.ndarray, label: np.ndarray, parts: int) -> None:
        rng, want = np.random.default_rng(0), np.eye(parts)[label]
        p = [rng.standard_normal((x.shape[1], parts)) * 0.01, np.zeros(parts)]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        for step in range(1, 301):
            z = x @ p[0] + p[1]
            z = np.exp(z - z.max(1, keepdims=True))
            d = (z / z.sum(1, keepdims=True) - want) / len(x)
            for k, g in enumerate((x.T @ d + 1e-4 * p[0] / 10, d.sum(0))):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                p[k] = p[k] - 0.1 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-9)
        self.weights, self.bias = p

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = x * self.scale @ self.weights + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def _calibrate(self, sample: np.ndarray, out: np.ndarray, near: np.ndarray, parts: int) -> None:
        """Set the mass by the neighbours ``near`` (places in the sample) of the vectors held ``out``."""
        p = self.probabilities(sample)
        part, p = p.argmax(1), p[out]
        order = np.argsort(-p, 1)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(parts)[None], 1)
        before = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
        # Probability ahead of the part in which each neighbour lies: it is probed if that is below the mass.
        ahead = np.take_along_axis(before, np.take_along_axis(place, part[near], 1), 1)
        self.mass = float(np.quantile(ahead, RECALL)) + 1e-9

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.probabilities(x).argmax(1)

    def routes(self, x: np.ndarray, held: np.ndarray, least: int) -> list[np.ndarray]:
        """The parts each query goes to: those of the mass, and further ones until ``least`` candidates are held."""
        p = self.probabilities(x)
        order = np.argsort(-p, 1, kind="stable")
        ahead = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
        some = np.cumsum(held[order], 1) - held[order]          # candidates in the parts ahead
        return [o[(a < max(self.mass, 1e-9)) | (n < least)] for o, a, n in zip(order, ahead, some)]


def _matrix(column) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def fit(vectors: DataFrame, sample: int = SAMPLE) -> tuple[Partitioner, int]:
    """A partitioner from ``sample`` of the staged distinct vectors, and the length in bytes of its vectors.

    The number of parts follows from the sample alone, so that the parts a query
    goes to do not become more as the table grows.
    """
    rows = [r["vec"] for r in vectors.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).collect()]
    lengths = pd.Series([len(r) for r in rows], dtype=int)
    size = int(lengths.mode().iloc[0]) if len(rows) else 0
    x = _matrix([r for r in rows if len(r) == size]) if rows else np.zeros((0, 1))
    return Partitioner(x, max(1, len(x) // PART_SAMPLE)), size


def nearest(vectors: DataFrame, is_query: Column, k: int, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by inner product found for each query row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("q"))
    every = stage(_distinct(rows.select("id", "v"), k + 1), "ann-vectors")
    model, size = fit(every)
    every = every.where(F.length("vec") == size)
    sent = spark.sparkContext.broadcast(model)          # dimensions x parts numbers

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = sent.value.part(_matrix(batch.column(0)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], names=["vec", "ids", "part"])
    index = stage(every.mapInArrow(place, "vec binary, ids array<long>, part int"), "ann-index")

    held = np.zeros(len(model.bias), np.int64)          # candidates of each part
    for r in index.groupBy("part").agg(F.sum(F.size("ids")).alias("n")).collect():      # a row a part
        held[r["part"]] = r["n"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                to = sent.value.routes(_matrix(batch.column(0)), held, k + 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.astype(np.int32) for t in to], pa.list_(pa.int32()))],
                                                 names=["vec", "qkey", "parts"])
    # Every query row, and the smallest query id of its vector, under which the vector is searched.
    asked = stage(_bytes(rows.where("q"), size), "ann-queries")
    keys = asked.groupBy("vec").agg(F.min("id").alias("qkey"))
    routed = stage(keys.mapInArrow(route, "vec binary, qkey long, parts array<int>")
                   .select("vec", "qkey", F.explode("parts").alias("part")), "ann-routes")
    # Chunks: a part's candidates and its queries are each dealt over as many as their numbers ask for.
    sizes = stage(index.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("cn"))
                  .join(routed.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("qn")), "part"),
                  "ann-chunks")
    deal = lambda df, mine, other: (df.join(F.broadcast(sizes), "part")  # noqa: E731  one row a part: bounded by SAMPLE
                                    .withColumn(mine, F.pmod(F.xxhash64("vec"), f"{mine}n"))
                                    .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}n") - 1)))
                                    .drop("cn", "qn"))
    left, right = deal(index, "c", "q"), deal(routed, "q", "c")

    def score(cand: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(cand) and len(query):
            x, y = _matrix(cand["vec"]), _matrix(query["vec"])
            ids = cand["ids"].to_list()
            take, longest = min(len(x), k + 1), np.sqrt((x * x).sum(1).max())
            for a in range(0, len(y), 256):
                rough = y[a:a + 256] @ x.T
                last = np.partition(rough, len(x) - take, 1)[:, len(x) - take]
                # Rough scores are off by rounding only; whatever may tie with the last one is ranked exactly.
                margin = 1e-13 * x.shape[1] * longest * np.sqrt((y[a:a + 256] ** 2).sum(1))
                for q, row, least in zip(range(a, len(y)), rough, last - margin):
                    b = np.flatnonzero(row >= least)
                    exact = (x[b] * y[q]).sum(1)        # the measure itself, in one order for all
                    found = sorted((-s, i) for s, j in zip(exact.tolist(), b) for i in ids[j])[:k + 1]
                    out += [(query["qkey"].iat[q], int(i), -s) for s, i in found]
        return pd.DataFrame(out, columns=["qkey", "vec_id", "score"])
    found = (left.groupBy("part", "c", "q").cogroup(right.groupBy("part", "c", "q"))
             .applyInPandas(score, "qkey long, vec_id long, score double"))
    ranked = lambda by: F.row_number().over(Window.partitionBy(by).orderBy(F.col("score").desc(), "vec_id"))
    best = stage(found.withColumn("r", ranked("qkey")).where(F.col("r") <= k + 1).drop("r"), "ann-found")
    answers = (asked.join(keys, "vec").select(F.col("id").alias("query_id"), "qkey").distinct().join(best, "qkey")
               .where("vec_id != query_id"))
    return (answers.withColumn("rank", ranked("query_id")).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _bytes(rows: DataFrame, size: int) -> DataFrame:
    """(id, vec) of valid rows whose vector has ``size`` bytes as doubles."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is not None and v.is_valid and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    if x.nbytes == size and np.isfinite(x).all() and x.any():
                        got.append((i, x.tobytes()))
            yield pa.RecordBatch.from_pydict({"id": pa.array([g[0] for g in got], pa.int64()),
                                              "vec": pa.array([g[1] for g in got], pa.binary())})
    return rows.select("id", "v").mapInArrow(work, "id long, vec binary")
