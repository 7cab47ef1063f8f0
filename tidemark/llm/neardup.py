"""Near-duplicate documents by SetSketch registers.

1. Each text gets a key of its word sequence, the number of its distinct word
   shingles and a sketch; texts of one key are one class (exact copies).
2. Classes that agree in all registers of a band share a bucket.
3. Each bucket's hub is the member with most company over all bands; a class is
   compared with the ``HUBS`` most frequented of its buckets' hubs: likely pairs by
   the sketches' joint likelihood are confirmed on full shingle sets, and linked
   classes joined to components.
4. Buckets that still hold several components are compared inside, only across
   components, block by block: again by likelihood, then on full sets.  A pair
   comes from the first band in which it agrees, so it is compared once.

Copies never meet each other, and members of a group that its hub joins are not
compared any more.  What grows faster than the input is step 4 in buckets of
many texts that are alike but under the threshold; its pairs stay inside tasks:
likely pairs travel as lists of partners, dealt into blocks of classes that share
hubs, and a class's text moves once for each block, not for each pair.  Bands are as wide as
lets a pair at the threshold share none in at most ``MISS`` of all cases (8 registers
at 0.85, 3.8 in 100,000; 6 at 0.80, 3 in a million), and the slack is ``DEVIATIONS``
standard deviations of the estimate (under 4 in a million).

Defined cases: null texts and texts without words have 0 shingles and are linked
with nothing; texts with fewer words than a shingle have their whole sequence
as one; repeated rows are exact copies; a null doc_id counts after all others;
an empty table gives an empty table; extra columns are ignored or, in
``keep_one``, carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import setsketch as ss
from tidemark.llm.common import drop, packed, released, small_batches, stage
from tidemark.llm.components import components

MISS = 5e-5             # chance that a pair at the threshold shares no band
DEVIATIONS = 4.5        # of the estimate, by which it may lie under the threshold and still be confirmed on full sets
HUBS = 2                # hubs a class is compared with
BLOCK = 2048            # members of a bucket compared with each other in one place
SETS = 1 << 22          # shingles of the classes confirmed with each other in one place, on either side
_SLICE = 1 << 20


def _texts(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Slices of a text column as each text's word hashes, with the row each slice begins at."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(lengths) // _SLICE)) + 1).tolist(), len(lengths)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        data = b"".join(t.encode() if t else b"" for t in column.slice(a, b - a).to_pylist())
        words, text = ss.word_hashes(np.frombuffer(data, np.uint8), np.cumsum(lengths[a:b]))
        at = np.searchsorted(text, np.arange(b - a + 1))
        yield a, [words[at[i]:at[i + 1]] for i in range(b - a)]


def _key(words: np.ndarray) -> bytes:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each document: id, h (hash of its text), cls (key of its word sequence), n (shingles), registers (binary)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in _texts(batch.column(1)):
                sets = [ss.shingle_hashes(w) for w in texts]
                rows = ss.sketch(sets)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).slice(a, len(texts)), "h": batch.column(2).slice(a, len(texts)), "cls": pa.array(map(_key, texts), pa.binary()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "registers": pa.array([r.tobytes() for r in rows], pa.binary())})
    return (small_batches(docs).select(F.col(key).cast("long"), text, F.xxhash64(text).alias("h"))
            .mapInArrow(released(work, ss.forget), "id long, h long, cls binary, n long, registers binary"))


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, ss.M)


def band_width(percent: int) -> int:
    """Registers of a band: the most with which a pair at the threshold meets in all but MISS of cases."""
    agree = 1 - 2 * float(ss._p(np.array([0.5 - 0.5 * percent / 100]))[0])      # a register's chance, for sets of one size
    wide = [w for w in range(1, 17) if (1 - agree ** w) ** (ss.M // w) <= MISS]
    return max(wide, default=1)


def slack(percent: int) -> float:
    """How far under the threshold an estimate may lie."""
    return DEVIATIONS * float(np.sqrt(percent / 100 * (1 - percent / 100) / ss.M))


def _bands(classes: DataFrame, width: int) -> DataFrame:
    """A row (bucket, cls, n) for each band of each class."""
    own = F.transform(F.sequence(F.lit(0), F.lit(ss.M // width - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.substring(F.col("registers"), b * (2 * width) + 1, F.lit(2 * width))).alias("hash")))
    return classes.where("n > 0").select("cls", "n", F.explode(own).alias("x")).select(
        F.col("x.hash").alias("bucket"), F.col("x.band").alias("band"), "cls", "n")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, place) whose sketches make the threshold likely enough to be worth confirming."""
    side = lambda s: classes.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "place", "n_a", "n_b", "r_a", "r_b")
    least = percent / 100 - slack(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                n = [part.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (3, 4)]
                j = ss.jaccard(_registers(part.column(5)), _registers(part.column(6)), *n)
                yield pa.RecordBatch.from_arrays(part.columns[:3], names=["a", "b", "place"]).filter(
                    pa.array(j >= least))
    return both.mapInArrow(released(work, ss.forget), "a binary, b binary, place long")


def _similar(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets have 100 * intersection >= percent * union with ``own`` (all sorted, without repeats or empty ones)."""
    size = np.array([len(o) for o in others])
    laid = np.concatenate(others)
    hit = own[np.minimum(own.searchsorted(laid), len(own) - 1)] == laid
    shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
    return 100 * shared >= percent * (len(own) + size - shared)


def _confirmed(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar, of members (lo, hi, cls, partners).

    A place (lo, hi) holds a row for each class that it compares, with the classes to compare it with.
    """
    # A class meets a partner once in a place, so its partners there are at most the place's classes.
    rows = members.groupBy("lo", "hi", "cls").agg(F.flatten(F.collect_list("partners")).alias("partners"))
    laid = (rows.join(texts, "cls").select("lo", "hi", "cls", "partners", "text")
            .repartition("lo", "hi").sortWithinPartitions("lo", "hi"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, np.ndarray] = {}
        wanted: dict[bytes, list[bytes]] = {}

        def out() -> pa.RecordBatch:
            a, b = [], []
            for cls, partners in wanted.items():
                at = 0
                while at < len(partners):
                    end, held = at, 0
                    while end < len(partners) and (end == at or held < 1 << 20):
                        held += len(sets[partners[end]])
                        end += 1
                    some = partners[at:end]
                    found = [p for p, ok in zip(some, _similar(sets[cls], [sets[p] for p in some], percent)) if ok]
                    a += [cls] * len(found)
                    b += found
                    at = end
            sets.clear()
            wanted.clear()
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
        now = None
        for batch in batches:           # rows come sorted by place
            for i in range(batch.num_rows):
                place = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if place != now and sets:
                    yield out()
                now, cls = place, batch.column(2)[i].as_py()
                sets[cls] = next(ss.shingle_hashes(w[0]) for _, w in _texts(batch.column(4).slice(i, 1)))
                if partners := batch.column(3)[i].as_py():
                    wanted[cls] = partners
        if sets:
            yield out()
    return laid.mapInArrow(released(work, ss.forget), "a binary, b binary")


def _across(comp: np.ndarray, n: np.ndarray, k: np.ndarray, fresh: np.ndarray, band: int,
            percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Likely pairs across components among a bucket's members, as a member and its partners (by their places in the
    arrays); pairs without a ``fresh`` member are left to others."""
    least, width = percent / 100 - slack(percent), band_width(percent)
    for i in range(len(comp) - 1):
        j = np.arange(i + 1, len(comp))
        j = j[(comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))
              & (fresh[j] | fresh[i])]
        for at in range(0, len(j), 4096):
            part = j[at:at + 4096]
            same = k[part] == k[i]
            # Far fewer equal registers than the least similarity would give: not worth the likelihood.
            near = same.sum(1) >= (least - 0.1) * ss.M
            part, same = part[near], same[near]
            if not len(part):
                continue
            bands = same[:, :ss.M // width * width].reshape(len(part), -1, width).all(2)
            first = bands.argmax(1)
            part = part[first == band]
            if len(part):
                est = ss.jaccard(np.broadcast_to(k[i], (len(part), ss.M)), k[part],
                                 np.full(len(part), float(n[i])), n[part].astype(float))
                if (est >= least).any():
                    yield i, part[est >= least]


def _leftover(rows: DataFrame, percent: int) -> DataFrame:
    """Members (lo, hi, cls, partners) of the likely pairs across components in buckets given as (bucket, band, size, cls,
    comp, n, registers, place); a pair is in the place (lo, hi) of its classes' own places."""
    chunks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), chunks.cast("long")).cast("int")
    placed = rows.withColumn("own", own).withColumn("x", F.explode(F.transform(
        F.sequence(F.lit(0), chunks - 1), lambda c: F.struct(F.least(c, F.col("own")).alias("lo"),
                                                             F.greatest(c, F.col("own")).alias("hi")))))
    laid = (placed.select("bucket", "band", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"), "own", "cls", "comp",
                          "n", "registers", "place")
            .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(t: pa.Table):
            group = np.array([(b, x, y) for b, x, y in zip(*(t.column(c).to_pylist() for c in ("bucket", "lo", "hi")))])
            ends = np.r_[0, np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1, len(group)]
            comp = np.unique(np.array(t.column("comp").to_pylist(), "S16"), return_inverse=True)[1]
            n, own = t.column("n").to_numpy(), t.column("own").to_numpy()
            k, band = _registers(t.column("registers")), t.column("band").to_numpy()
            for a, b in zip(ends, ends[1:]):
                lo, hi = group[a, 1], group[a, 2]
                # A pair of two chunks is compared where both are; one within a chunk in its own place.
                side = own[a:b]
                if lo == hi:
                    for i, j in _across(comp[a:b], n[a:b], k[a:b], np.ones(b - a, bool), band[a], percent):
                        yield a + i, a + j
                else:
                    j = np.flatnonzero(side == hi)
                    for i in np.flatnonzero(side == lo):
                        at = np.r_[i, j] + a
                        fresh = np.r_[True, np.zeros(len(j), bool)]
                        for _, found in _across(comp[at], n[at], k[at], fresh, band[a], percent):
                            yield at[0], at[found]

        def out(t: pa.Table) -> Iterator[pa.RecordBatch]:
            cls, place = t.column("cls").to_pylist(), t.column("place").to_numpy()
            found: dict[tuple[int, int, bytes], list[bytes]] = {}
            for i, js in pairs(t):
                for j in js.tolist():
                    lo, hi = sorted((int(place[i]), int(place[j])))
                    found.setdefault((lo, hi, cls[i]), []).append(cls[j])
                    found.setdefault((lo, hi, cls[j]), [])
            keys = list(found)
            for at in range(0, len(keys), 1000):
                some = keys[at:at + 1000]
                yield pa.RecordBatch.from_pydict({
                    "lo": pa.array([x[0] for x in some], pa.int64()), "hi": pa.array([x[1] for x in some], pa.int64()),
                    "cls": pa.array([x[2] for x in some], pa.binary()),
                    "partners": pa.array([found[x] for x in some], pa.list_(pa.binary()))})
        held: list[pa.RecordBatch] = []
        for batch in batches:           # rows come sorted: all but the last group of a batch are complete
            t = pa.Table.from_batches([*held, batch])
            if t.num_rows == 0:
                continue
            last = tuple(t.column(c)[-1].as_py() for c in ("bucket", "lo", "hi"))
            open_ = pc.and_(pc.and_(pc.equal(t.column("bucket"), last[0]), pc.equal(t.column("lo"), last[1])),
                            pc.equal(t.column("hi"), last[2]))
            done = t.filter(pc.invert(open_))
            if done.num_rows:
                yield from out(done.combine_chunks())
            held = t.filter(open_).to_batches()
        if held:
            yield from out(pa.Table.from_batches(held).combine_chunks())
    return laid.mapInArrow(released(work, ss.forget), "lo long, hi long, cls binary, partners array<binary>")


def duplicate_components(docs: DataFrame, *, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's id, h (hash of its text), cls, n, and its component's smallest document (comp_id, comp_cls).

    Links are 100 * intersection >= ``percent`` * union of the shingle sets.
    """
    spark = docs.sparkSession
    sketched = stage(sketches(docs, key=key, text=text), "sketches")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    classes = stage(sketched.groupBy("cls").agg(F.first("n").alias("n"), F.first("registers").alias("registers"),
                                                F.min(order).alias("least")), "classes")
    bands = _bands(classes, band_width(percent))
    counted = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stage(bands.join(counted, "bucket"), "buckets")
    # The text of each class that meets another: that of its least document.  Texts move by document, and
    # only a class's one text by class: a class of many copies is no hot key.
    meet = members.select("cls").distinct()
    least = classes.join(meet, "cls", "left_semi").select("cls", F.col("least.id").alias("id2"), F.col("least.h").alias("h"))
    own_text = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    texts = stage(_representatives(own_text, least), "class-texts")
    company = members.groupBy("cls").agg(F.sum("size").alias("company"))
    hubs = (members.join(company, "cls").groupBy("bucket")
            .agg(F.max(F.struct("company", "cls", "n")).alias("hub")))
    near = lambda m, n: F.expr(f"100 * least({m}, {n}) >= {percent} * greatest({m}, {n})")
    met = (members.join(hubs, "bucket").where((F.col("cls") != F.col("hub.cls")) & near("n", "hub.n"))
           .select(F.col("cls").alias("a"), F.struct("hub.company", F.col("hub.cls").alias("b"), "hub.n").alias("hub")))
    # Of the hubs a class meets (one a band at most) those with most company: what they leave apart, step 4 compares.
    stars = stage(met.groupBy("a").agg(F.slice(F.sort_array(F.collect_set("hub"), False), 1, HUBS).alias("hubs")), "hubs")
    # A hub's members are dealt into places of bounded size; they are no more than its company, each of about its size.
    parts = F.ceil(F.col("hub.company") * F.col("hub.n") / SETS)
    likely = stage(_likely(stars.select("a", F.explode("hubs").alias("hub")).select(
        "a", "hub.b", F.xxhash64("hub.b", F.pmod(F.xxhash64("a"), parts)).alias("place")), classes, percent), "likely")
    none = F.array().cast("array<binary>")
    place = [F.col("place").alias("lo"), F.col("place").alias("hi")]
    starred = likely.select(*place, F.col("a").alias("cls"), F.array("b").alias("partners")).union(
        likely.select(*place, F.col("b").alias("cls"), none.alias("partners")).distinct())
    links = stage(_confirmed(starred, texts, percent), "star-links")
    label = components(links)
    own = members.join(label.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "comp", F.coalesce("label", "cls")).drop("label")
    mixed = own.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 != c1").select("bucket")
    # Classes with one foremost hub stand together, in places of bounded size.
    home = meet.join(stars.select(F.col("a").alias("cls"), F.col("hubs")[0]["b"].alias("hub")), "cls", "left").select(
        "cls", F.coalesce("hub", "cls").alias("home"))
    sizes = home.join(classes, "cls").groupBy("home").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / SETS)).alias("parts")).where("parts > 1")     # few, by their size
    placed = home.join(sizes, "home", "left").select(
        "cls", F.xxhash64("home", F.pmod(F.xxhash64("cls"), F.coalesce("parts", F.lit(1)))).alias("place"))
    open_rows = (own.join(mixed, "bucket", "left_semi").join(classes.select("cls", "registers"), "cls")
                 .join(placed, "cls"))
    more = stage(_confirmed(_leftover(open_rows, percent), texts, percent), "further-links")
    if not more.isEmpty():
        label = components(links.union(more))
    node = classes.join(label.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "least", F.coalesce("label", "cls").alias("comp"))
    best = node.groupBy("comp").agg(F.min(F.struct("least", "cls")).alias("best"))
    of = stage(node.join(best, "comp").select("cls", F.col("best.least.id").alias("comp_id"),
                                              F.col("best.cls").alias("comp_cls")), "class-components")
    drop(spark, members, texts)
    alone = F.col("n") == 0
    return sketched.select("id", "h", "cls", "n").join(of, "cls").select(
        "id", "h", "cls", "n", F.when(alone, F.col("id")).otherwise(F.col("comp_id")).alias("comp_id"), "comp_cls")


def _representatives(docs: DataFrame, least: DataFrame) -> DataFrame:
    """(cls, text) for each class of ``least`` (cls, id2, h), from ``docs`` (id, text, h): joined by id and text hash, so
    that neither null ids nor copies gather; rows repeated under one id count once."""
    none = lambda c: F.col(c).isNull()
    wanted = least.select("cls", F.col("h").alias("h2"), F.coalesce("id2", F.lit(0)).alias("i2"), none("id2").alias("n2"))
    rows = docs.select("text", "h", F.coalesce("id", F.lit(0)).alias("i"), none("id").alias("n")).dropDuplicates(["i", "n", "h"])
    same = (F.col("i") == F.col("i2")) & (F.col("n") == F.col("n2")) & (F.col("h") == F.col("h2"))
    return rows.join(wanted, same).select("cls", "text")


def _with_class(rows: DataFrame) -> DataFrame:
    """Add the class key to rows (..., text)."""
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for a, texts in _texts(batch.column(at)):
                part = batch.slice(a, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(map(_key, texts), pa.binary())], names=[*names, "cls"])
    return rows.mapInArrow(released(work, ss.forget), rows.select("*", F.lit(b"").alias("cls")).schema)


def near_duplicates(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, of every document."""
    found = duplicate_components(docs, percent=percent)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp_id").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("comp_id")).alias("kept"))


def keep_one(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does; texts without words all stay.

    Who stays is worked out from ids and hashes; a document's row moves once, by its own id and text hash.
    """
    found = duplicate_components(docs, percent=percent)
    stay = (found.where("n = 0 or (cls = comp_cls and id <=> comp_id)")
            .select(F.col("id").isNull().alias("_n"), F.coalesce("id", F.lit(0)).alias("_i"), "h", (F.col("n") == 0).alias("_all")))
    # Copies under one id may differ in spacing only: of each class one text hash is left.
    one = found.where("n > 0 and cls = comp_cls and id <=> comp_id").groupBy("cls").agg(F.min("h").alias("h")).select("h")
    stay = stay.where("_all").unionByName(stay.where("not _all").join(one.withColumnRenamed("h", "h1"), F.col("h") == F.col("h1"),
                                                                    "left_semi")).distinct()
    given = F.col("_row.doc_id").cast("long")
    rows = docs.select(packed(docs).alias("_row"), F.xxhash64("text").alias("h"))
    rows = rows.withColumns({"_n": given.isNull(), "_i": F.coalesce(given, F.lit(0))})
    kept = rows.join(stay, ["_n", "_i", "h"])
    once = kept.where("not _all").dropDuplicates(["_n", "_i", "h"]).select("_row")
    return once.unionByName(kept.where("_all").select("_row")).select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
