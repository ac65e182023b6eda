"""Item-item cosine similarity and the K nearest items of each catalog item.

sim(i, j) = sum_u r_ui * r_uj / (||r_i|| * ||r_j||), norms over *all* ratings of the item.

Strips
------
No co-rated pair is shuffled.  Items are dealt to *strips* by a hash, so that a strip's items have about
``STRIP_PAIRS`` co-rated pairs in all (fewer while there are not enough strips to occupy the cluster), and every
user's ratings travel once, as a list, to each strip that holds an item of that user (an inverted index of
users).  The lists of many users and one strip are one compact blob (``packing``), two to three bytes an entry: ids
as differences, ratings, and whether an entry is the strip's own.  The items' squared norms go to each strip once
while that is less than with every entry and a task may hold them; then ratings aren't joined with facts of items on the way.  A
task holds the lists of one strip and adds up the dot products of its items a few at a time, complete.

* A user above ``block_size`` ratings is cut into blocks of items, and blocks meet in pairs, so no
  list grows with the user.
* An item with more than ``ITEM_PAIRS`` pairs gets strips of its own, dealt by user; these
  return partial dot products, which are summed as rows (at most items x parts of them).

``item_neighbors`` leaves only the K nearest of each item in the tasks' output.  ``pair_dots`` and
``pair_similarities``, whose result are the pairs, send an item only the entries of a list from that item
on, and the pairs are the tasks' output.

With half-star ratings every partial sum is exact.  One division gives the cosine, which is ranked
unrounded; as a weight it is an integer in 1e-12 steps (at least 1), which keeps the sums over a
few hundred neighbours exact.  The item itself is one of its K neighbours.
"""

from __future__ import annotations


from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.operators.joins import fits_broadcast, maybe_broadcast
from cinerank.operators.packing import (PACK_ROWS, Codec, Places, binary_rows, codec, flat, from_gaps, gaps, heads, is_half_step, pack,
                                        sort_order, spread, unpack)
from cinerank.operators.rank import top_n
from cinerank.session import materialize

DEFAULT_K = 100
DEFAULT_BLOCK = 1024
WEIGHT_UNIT = 1e12
STRIP_PAIRS = 32_000_000  # co-rated pairs of a strip: at most as many list entries in a task
FEW_PAIRS = 1_000_000  # a strip of a small table
ITEM_PAIRS = 4_000_000  # of an item in a strip with others
CHUNK_PAIRS = 2_000_000  # that a task adds up at once (one item more, at most)
NORM_ITEMS = 16_000_000  # whose squared norms a task holds
NORM_SHARE = 0.5  # bytes of an entry's norm by those of a norm on its own
NO_STRIP = -(1 << 62)  # of entries that are only partners
OWN, MET = 1, 2  # an entry is the strip's own; others of its list meet it
NORMS, LISTS = 0, 1  # kinds of blobs, in the order a strip reads them


def _squares():
    return F.sum(F.col("rating") * F.col("rating"))


def _blocked(ratings: DataFrame, block_size: int, cut: bool) -> tuple[DataFrame, bool]:
    """``userId, movieId, rating, nb, blk``: the user's number of blocks and the item's block; whether
    any user has several.  Only users above ``block_size`` ratings (at most rows / block_size) are joined back.
    """
    heavy = (ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n_u")).where(F.col("n_u") > block_size)
             .select("userId", F.ceil(F.col("n_u") / F.lit(block_size)).cast("int").alias("nb")))
    if cut:
        heavy = materialize(heavy, "heavy_users")
    r = ratings.select("userId", "movieId", "rating")
    if not heavy.limit(1).count():
        return r.withColumns({"nb": F.lit(1), "blk": F.lit(0)}), False
    r = r.join(heavy, "userId", "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    return r.withColumn("blk", F.pmod(F.xxhash64("movieId"), F.col("nb")).cast("int")), True


def item_norms(ratings: DataFrame) -> DataFrame:
    """``movieId, norm`` (L2 norm of the item's ratings)."""
    return ratings.groupBy("movieId").agg(F.sqrt(_squares()).alias("norm"))


def cosine(dot, n2_i, n2_j):
    """Unrounded: exact sums, correctly rounded roots, one product and one division."""
    den = F.sqrt(n2_i) * F.sqrt(n2_j)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot / den)


def weight(sim):
    """A positive similarity as an integer in 1e-12 steps, at least 1; 0 otherwise."""
    sim = F.col(sim) if isinstance(sim, str) else sim
    return F.when(sim > 0, F.greatest(F.lit(1), F.floor(sim * F.lit(WEIGHT_UNIT) + F.lit(0.5)))).otherwise(F.lit(0)).cast("long")


def _with_similarity(dots: DataFrame, n2: DataFrame, i: str, j: str) -> DataFrame:
    """``i, j, sim`` from ``i, j, dot`` and the items' squared norms (``movieId, n2``)."""
    side = lambda c: n2.select(F.col("movieId").alias(c), F.col("n2").alias(f"n2_{c}"))
    return dots.join(side(i), i).join(side(j), j).select(i, j, cosine(F.col("dot"), F.col(f"n2_{i}"), F.col(f"n2_{j}")).alias("sim"))


def _item_facts(ratings: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """``movieId, n2, work, halves, met, listed``: squared norm, co-rated pairs of the item, whether its ratings are
    half steps, how many they are, whether the catalog has it (without a catalog all count)."""
    n_u = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n_u"))
    facts = (ratings.select("userId", "movieId", "rating").join(n_u, "userId")
             .groupBy("movieId").agg(_squares().alias("n2"), F.sum("n_u").alias("work"), F.min(is_half_step()).alias("halves"),
                                    F.count(F.lit(1)).alias("met")))
    if catalog is None:
        return facts.withColumn("listed", F.lit(True))
    known = catalog.select("movieId", F.lit(True).alias("listed")).distinct()
    return facts.join(known, "movieId", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


class StripPlan(NamedTuple):
    """Numbers that the strips are made with."""

    strips: int
    item_pairs: int
    code: Codec
    norm_type: str  # squared norms: quarters in 32 bits, or as they are
    norms_apart: bool  # norms go to a strip once, not with every entry

    @property
    def norm_step(self) -> float:
        return 0.25 if self.norm_type == "u4" else 1.0

    @property
    def list_types(self) -> list[str]:
        """Sizes of the lists; of their entries id, rating, ``OWN`` and ``MET``, squared norm unless it goes apart."""
        return ["u4", self.code.id_type, self.code.rating_type, "u1", self.norm_type]

    @property
    def norm_types(self) -> list[str]:
        return [self.code.id_type, self.norm_type]


def strip_plan(facts: DataFrame, strip_pairs: int) -> StripPlan:
    listed = F.coalesce(F.sum(F.when(F.col("listed"), F.col("work"))), F.lit(0))
    total, least, most, halves, norm, items, entries = facts.agg(
        listed, F.min("movieId"), F.max("movieId"), F.min("halves"), F.max("n2"), F.count(F.lit(1)), F.coalesce(F.sum("met"), F.lit(0))).first()
    busy = 2 * facts.sparkSession.sparkContext.defaultParallelism
    strips = max(1, -(-int(total) // strip_pairs), min(busy, int(total) // FEW_PAIRS))
    # A list goes to the strips of its items: at least as many entries as there are ratings, at most pairs.
    sent = int(entries) * min(strips, max(1, int(total) // max(1, int(entries))))
    return StripPlan(strips, min(strip_pairs, ITEM_PAIRS), codec(least, most, halves), "u4" if halves and norm < 1 << 29 else "f8",
                     items <= NORM_ITEMS and items * strips <= sent * NORM_SHARE)


def strip_lists(ratings: DataFrame, facts: DataFrame, strip_pairs: int, block_size: int, cut: bool,
                plan: StripPlan | None = None, upward: bool = False) -> DataFrame:
    """``strip, lists``: the ratings of some users that a strip's items meet (``StripPlan.list_types``), each list
    cut into blocks for users above ``block_size`` ratings.  ``upward``: an item meets itself and higher ids only.
    Strips below 0 hold a part of the users of items that have more than ``plan.item_pairs`` pairs.
    """
    plan = plan or strip_plan(facts, strip_pairs)
    # Only items with many pairs (at most pairs / item_pairs) and those outside the catalog are joined to the ratings.
    parts = F.when(F.col("listed"), F.ceil(F.col("work") / F.lit(plan.item_pairs))).otherwise(F.lit(0))
    others = facts.where((F.col("work") > plan.item_pairs) | ~F.col("listed")).select("movieId", parts.alias("parts"))
    strip = F.pmod(F.xxhash64("movieId"), F.lit(plan.strips))
    r, any_heavy = _blocked(ratings.where(F.col("movieId").isNotNull()), block_size, cut)
    if not plan.norms_apart:
        others = facts.select("movieId", F.col("n2").cast("double").alias("n2"), F.when((F.col("work") > plan.item_pairs) | ~F.col("listed"), parts).alias("parts"))
    n_others = others.count()
    r = r.withColumn("n2", F.lit(None).cast("double")) if plan.norms_apart else r
    if n_others:
        r = r.join(maybe_broadcast(others, fits_broadcast(n_others)), "movieId", "left" if plan.norms_apart else "inner")
        alone = -1 - F.pmod(F.xxhash64("movieId", F.pmod(F.xxhash64("userId"), F.greatest(F.col("parts"), F.lit(1)))), F.lit(1 << 40))
        strip = F.when(F.col("parts").isNull(), strip).when(F.col("parts") > 0, alone).otherwise(F.lit(NO_STRIP))
    r = r.withColumn("strip", strip.cast("long"))
    cols = ["userId", "movieId", F.col("rating").cast("double").alias("rating"), "n2"]
    key = ["userId"]
    if any_heavy:  # every block meets every block; own items of one, partners of the other
        key = ["userId", "_a", "_b"]
        others = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
        own = (r.withColumn("_b", others).where(F.col("_b") != F.col("blk"))
               .select(*cols, F.col("blk").alias("_a"), "_b", "strip", F.lit(False).alias("met")))
        met = (r.withColumn("_a", others)
               .select(*cols, "_a", F.col("blk").alias("_b"),
                       F.when(F.col("_a") == F.col("blk"), F.col("strip")).otherwise(F.lit(NO_STRIP)).alias("strip"), F.lit(True).alias("met")))
        r = own.unionByName(met)
    else:
        r = r.select(*cols, "strip", F.lit(True).alias("met"))
    entry = F.struct(F.col("movieId").cast("long").alias("m"), "rating", "strip", "met", "n2")
    lists = r.groupBy(*key).agg(F.sort_array(F.collect_list(entry)).alias("e"))  # no exchange over ratings bucketed by user
    return lists.select("e.m", "e.rating", "e.strip", "e.met", "e.n2").mapInArrow(_packer(plan, upward), "strip long, lists binary")


def _first_of_id(code: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Place of the first entry with the same id in the entry's list; the lists end before ``ends``, ids ascend."""
    new = np.append(True, code[1:] != code[:-1])[:len(code)]
    new[ends[:-1]] = True
    return np.maximum.accumulate(np.where(new, np.arange(len(code)), 0)) if len(code) else np.zeros(0, dtype=np.int64)


def _packer(plan: StripPlan, upward: bool):
    """Blobs for every strip from lists with ``PACK_ROWS`` entries or more."""

    def blobs(movie, rating, strip, met, n2, size) -> Iterator[pa.RecordBatch]:
        code, rating = plan.code.ids(movie), plan.code.ratings(rating)
        norm = None if plan.norms_apart else (n2 / plan.norm_step).astype(plan.norm_type)
        ends = np.cumsum(size)
        begin, same = ends - size, _first_of_id(code, ends)
        own = np.flatnonzero(strip != NO_STRIP)
        own = own[np.argsort(strip[own], kind="stable")]
        a_list, a_strip = np.repeat(np.arange(len(size)), size)[own], strip[own]
        rows, held = [], 0
        cuts = heads(a_strip)
        for s, e in zip(cuts, np.append(cuts[1:], len(own))):
            number = int(a_strip[s])
            first = heads(a_list[s:e])
            of = a_list[s:e][first]
            least = same[own[s:e][first]] if upward else begin[of]  # a list's smallest own id comes first
            n = ends[of] - least
            at = spread(least, n)
            mark = (met[at] * MET + (strip[at] == number) * OWN).astype(np.uint8)
            each = np.add.reduceat(mark > 0, np.cumsum(n) - n, dtype=np.uint32)
            at, mark = at[mark > 0], mark[mark > 0]
            rows.append((number, pack([each, gaps(code[at]), rating[at], mark, np.zeros(0, dtype=plan.norm_type) if norm is None else norm[at]])))
            held += len(rows[-1][1])
            if held > 4 << 20:
                yield binary_rows(["strip", "lists"], rows)
                rows, held = [], 0
        if rows:
            yield binary_rows(["strip", "lists"], rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                movie, size = flat(batch.column(0))
                upto = np.cumsum(size.astype(np.int64))
                cols = [movie, *(flat(c)[0] for c in batch.columns[1:])]
                cuts = heads((upto - size) // PACK_ROWS)  # lists of many entries: a part of the batch at a time
                for s, e in zip(cuts, np.append(cuts[1:], len(size))):
                    lo, hi = upto[s] - size[s], upto[e - 1]
                    held.append([*(c[lo:hi] for c in cols), size[s:e].astype(np.int64)])
                    n += hi - lo
                    if n >= PACK_ROWS:
                        yield from blobs(*(np.concatenate(c) for c in zip(*held)))
                        held, n = [], 0
        if held:
            yield from blobs(*(np.concatenate(c) for c in zip(*held)))

    return run


def _norms(facts: DataFrame, plan: StripPlan) -> DataFrame:
    """``strip, lists``: the squared norms of all items (``StripPlan.norm_types``), for each whole strip."""

    def blobs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        movie, n2 = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in (0, 1))
        order = np.argsort(movie, kind="stable")
        blob = pack([gaps(plan.code.ids(movie[order])), (n2[order] / plan.norm_step).astype(plan.norm_type)])
        for strip in range(plan.strips):
            yield binary_rows(["strip", "lists"], [(strip, blob)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= PACK_ROWS:
                yield from blobs(held)
                held, n = [], 0
        if held:
            yield from blobs(held)

    items = facts.where(F.col("movieId").isNotNull()).select(F.col("movieId").cast("long"), F.col("n2").cast("double"))
    return items.mapInArrow(run, "strip long, lists binary")


class _Norms:
    def __init__(self, blobs: list[bytes], plan: StripPlan) -> None:
        parts = [unpack(b, plan.norm_types) for b in blobs]
        code = np.concatenate([from_gaps(p[0]) for p in parts])
        order = np.argsort(code, kind="stable")
        self.n2, self.step = np.concatenate([p[1] for p in parts])[order], plan.norm_step
        self.places = Places(code[order], plan.code.span)

    def of(self, codes: np.ndarray) -> np.ndarray:
        return self.n2[self.places.find(codes)] * self.step

    def known(self, codes: np.ndarray) -> np.ndarray:
        return self.places.find(codes) >= 0


def _joined(blobs: list[bytes], plan: StripPlan, upward: bool) -> list[np.ndarray]:
    """The lists of several blobs: own entries' ids, ratings, squared norms, first and last + 1 partner; partners' ids, ratings, norms.
    ``upward``: an item meets itself and higher ids only."""
    own, partners, before = [], [], 0
    for blob in blobs:
        size, code, rating, mark, norm = unpack(blob, plan.list_types)
        size, code = size.astype(np.int64), from_gaps(code)
        met = (mark & MET) > 0
        upto = np.append(0, np.cumsum(met)) + before  # partners before an entry
        a = np.flatnonzero(mark & OWN)
        ends = np.cumsum(size)
        of = np.searchsorted(ends, a, side="right")
        begin = _first_of_id(code, ends)[a] if upward else (ends - size)[of]
        own.append((code[a], rating[a], norm if plan.norms_apart else norm[a], upto[begin], upto[ends[of]]))
        partners.append((code[met], rating[met], norm if plan.norms_apart else norm[met]))
        before = int(upto[-1])
    return [np.concatenate(c) for c in (*zip(*own), *zip(*partners))]


def _sums(blobs: list[bytes], norms: _Norms | None, plan: StripPlan, upward: bool, chunk_pairs: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(i, j, dot, squared norm of i, of j) of a strip's pairs, sorted by (i, j); an item's pairs come in one piece.
    Only items with ``norms`` count; without any they came with the entries, or are zero in a part of an item."""
    a_code, a_rating, a_norm, begin, end, b_code, b_rating, b_norm = _joined(blobs, plan, upward)
    if norms:
        a_code, a_rating, begin, end = (x[keep] for keep in (norms.known(a_code),) for x in (a_code, a_rating, begin, end))
    order = np.argsort(a_code, kind="stable")
    a_code, a_rating, begin, end = (x[order] for x in (a_code, a_rating, begin, end))
    a_norm = a_norm[order] if len(a_norm) else a_norm
    each = end - begin
    first = heads(a_code)
    piece = (np.cumsum(each) - each)[first] // chunk_pairs
    cuts = np.append(first[heads(piece)], len(a_code))
    for s, e in zip(cuts[:-1], cuts[1:]):
        item_at = heads(a_code[s:e])
        item = np.repeat(np.cumsum(np.isin(np.arange(e - s), item_at, assume_unique=True)) - 1, each[s:e])
        at_b = spread(begin[s:e], each[s:e])
        b = b_code[at_b]
        if plan.code.span * len(item_at) < 1 << 62:
            span, b = plan.code.span, b.astype(np.int64)
        else:
            ids, b = np.unique(b, return_inverse=True)
            span = len(ids)
        order, key = sort_order(item * span + b, span * len(item_at))
        head = heads(key)
        value = (np.repeat(a_rating[s:e] * plan.code.step, each[s:e]) * (b_rating[at_b] * plan.code.step))[order]
        dot = np.add.reduceat(value, head) if len(head) else value
        to, of = at_b[order[head]], item_at[item[order[head]]] + s
        i, j = a_code[of], b_code[to]
        if norms:
            known = norms.known(j)
            i, j, dot = i[known], j[known], dot[known]
            na, nb = norms.of(i), norms.of(j)
        else:
            na, nb = (a_norm[of] * plan.norm_step, b_norm[to] * plan.norm_step) if len(a_norm) else (np.zeros(len(i)),) * 2
        yield plan.code.decoded(i), plan.code.decoded(j), dot, na, nb


def _by_strip(batches: Iterator[pa.RecordBatch], plan: StripPlan) -> Iterator[tuple[int, list[bytes], _Norms | None]]:
    """(strip, blobs of lists, norms of a whole strip) from rows sorted by strip."""
    now, blobs = None, ([], [])
    for batch in batches:
        for strip, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if strip != now:
                if blobs[LISTS]:
                    yield now, blobs[LISTS], _Norms(blobs[NORMS], plan) if blobs[NORMS] else None
                now, blobs = strip, ([], [])
            blobs[kind].append(blob.as_py())
    if blobs[LISTS]:
        yield now, blobs[LISTS], _Norms(blobs[NORMS], plan) if blobs[NORMS] else None


def _cosines(dot: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    den = np.sqrt(na) * np.sqrt(nb)
    return np.divide(dot, den, out=np.zeros(len(dot)), where=den != 0)


def _nearest(k: int, plan: StripPlan, chunk_pairs: int = CHUNK_PAIRS):
    """The K nearest of every item of a whole strip, all sums of a part of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for strip, blobs, norms in _by_strip(batches, plan):
            for a, b, dot, na, nb in _sums(blobs, norms, plan, False, chunk_pairs):
                if strip < 0:
                    place, value = np.zeros(len(a), dtype=np.int32), dot
                else:
                    value = _cosines(dot, na, nb)
                    head = heads(a)
                    keep = np.ones(len(a), dtype=bool)
                    for s, e in zip(head, np.append(head[1:], len(a))):
                        if e - s > k:
                            keep[s:e] = value[s:e] >= np.partition(value[s:e], e - s - k)[e - s - k]
                    a, b, value = a[keep], b[keep], value[keep]
                    order = np.lexsort((b, -value, a))
                    a, b, value = a[order], b[order], value[order]
                    head = heads(a)
                    place = np.arange(len(a)) - np.repeat(head, np.diff(np.append(head, len(a)))) + 1
                    a, b, value, place = (x[place <= k] for x in (a, b, value, place))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(value), pa.array(place, pa.int32())],
                                                 names=["movieId", "neighborId", "value", "rnk"])

    return run


def _every_pair(similar: bool, plan: StripPlan, chunk_pairs: int = CHUNK_PAIRS):
    """All pairs of every strip: the cosine or the dot product, which is always that of a part of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for strip, blobs, norms in _by_strip(batches, plan):
            for a, b, dot, na, nb in _sums(blobs, norms, plan, True, chunk_pairs):
                value = _cosines(dot, na, nb) if similar and strip >= 0 else dot
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(value), pa.array(np.full(len(a), strip < 0))],
                                                 names=["i", "j", "value", "part"])

    return run


def _strips(ratings: DataFrame, facts: DataFrame, plan: StripPlan, block_size: int, cut: bool, upward: bool) -> DataFrame:
    """``strip, kind, lists``: norms and lists with a strip's rows in one partition, one after the other.  Strips are dealt
    by number: by a hash several would meet in one task while others have none."""
    lists = strip_lists(ratings, facts, 0, block_size, cut, plan, upward)
    row = lambda df, kind: df.select("strip", F.lit(kind).alias("kind"), "lists")
    both = row(lists, LISTS)
    if plan.norms_apart:
        both = both.unionByName(row(_norms(facts, plan), NORMS))
    n = min(plan.strips, 1 << 14)
    return both.repartitionById(n, F.pmod("strip", F.lit(n)).cast("int")).sortWithinPartitions("strip", "kind")


def _pairs(ratings: DataFrame, block_size: int, cut: bool, strip_pairs: int, similar: bool) -> DataFrame:
    """``i, j, value`` for co-rated pairs with i <= j."""
    ratings = ratings.where(F.col("userId").isNotNull() & F.col("movieId").isNotNull())
    facts = _item_facts(ratings, None)
    if cut:
        facts = materialize(facts, "item_facts")
    plan = strip_plan(facts, strip_pairs)
    found = _strips(ratings, facts, plan, block_size, cut, True).mapInArrow(
        _every_pair(similar, plan), "i long, j long, value double, part boolean")
    whole = found.where(~F.col("part")).select("i", "j", "value")
    if not facts.where(F.col("work") > plan.item_pairs).limit(1).count():
        return whole
    if cut:
        found = materialize(found, "strip_sums")
        whole = found.where(~F.col("part")).select("i", "j", "value")
    sums = found.where("part").groupBy("i", "j").agg(F.sum("value").alias("value"))
    if similar:
        sums = _with_similarity(sums.withColumnRenamed("value", "dot"), facts.select("movieId", "n2"), "i", "j").withColumnRenamed("sim", "value")
    return whole.unionByName(sums)


def pair_dots(ratings: DataFrame, block_size: int = DEFAULT_BLOCK, cut: bool = True, strip_pairs: int = STRIP_PAIRS) -> DataFrame:
    """``i, j, dot`` for co-rated pairs with i <= j (diagonal included)."""
    return _pairs(ratings, block_size, cut, strip_pairs, False).withColumnRenamed("value", "dot")


def pair_similarities(ratings: DataFrame, block_size: int = DEFAULT_BLOCK, cut: bool = True,
                      strip_pairs: int = STRIP_PAIRS) -> DataFrame:
    """``i, j, sim`` for co-rated pairs with i <= j."""
    return _pairs(ratings, block_size, cut, strip_pairs, True).withColumnRenamed("value", "sim")


def item_neighbors(ratings: DataFrame, catalog: DataFrame, k: int = DEFAULT_K, block_size: int = DEFAULT_BLOCK,
                   cut: bool = True, strip_pairs: int = STRIP_PAIRS) -> DataFrame:
    """``movieId, neighborId, sim, w, rnk``: K most similar rated items of every rated catalog
    item (ties: lower id first) and their weights.  Items sharing no rater have similarity 0
    and add nothing to any prediction, so only co-rated pairs are kept."""
    facts = _item_facts(ratings, catalog)
    if cut:
        facts = materialize(facts, "item_facts")
    plan = strip_plan(facts, strip_pairs)
    found = _strips(ratings, facts, plan, block_size, cut, False).mapInArrow(
        _nearest(k, plan), "movieId long, neighborId long, value double, rnk int")
    hot = facts.where(F.col("listed") & (F.col("work") > plan.item_pairs)).limit(1).count()
    if hot and cut:
        found = materialize(found, "strip_sums")
    near = found.where(F.col("rnk") > 0).withColumnRenamed("value", "sim")
    if hot:
        sums = found.where(F.col("rnk") == 0).groupBy("movieId", "neighborId").agg(F.sum("value").alias("dot"))
        n2 = facts.select("movieId", "n2")
        sims = _with_similarity(sums.select(F.col("movieId").alias("i"), F.col("neighborId").alias("j"), "dot"), n2, "i", "j")
        ranked = top_n(sims, k, "i", [F.col("sim").desc(), F.col("j").asc()])
        near = near.unionByName(ranked.select(F.col("i").alias("movieId"), F.col("j").alias("neighborId"), "sim", "rnk"))
    return near.select("movieId", "neighborId", "sim", weight("sim").alias("w"), F.col("rnk").cast("int").alias("rnk"))
