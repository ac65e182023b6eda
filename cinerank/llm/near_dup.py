"""MinHash near-duplicate detection with odd sketches.

Documents whose sets of word shingles have a Jaccard similarity of at least ``threshold``
percent are linked; components of links are the duplicate groups.

1. One pass over the texts gives each document's set size, a 128-bit set fingerprint, MinHash
   band keys and an odd sketch: the MinHash samples folded into a 512-bit parity bitmap, so
   that the population count of the XOR of two bitmaps estimates how many samples differ.
2. Equal sets (exact copies in any number) become one *class* by a map-side combined
   aggregation; only one representative of each class goes on.
3. Every band bucket links its members to a leader of its own (chosen by hash, so each
   document meets up to ``bands`` different leaders): n - 1 candidate pairs, never all pairs.
   Size ratio and sketch drop most false candidates, the full shingle sets confirm the rest.
4. A bucket whose members are not all in one component after that may hide links between
   non-leaders.  What is left of such buckets is compared completely and exactly, in bounded
   blocks (member hash by member hash; a product of shingle incidence matrices gives all
   intersections of a block), so that no group is ever held whole by a task and no link is given
   up; a block returns only the links that join its components.
5. Components: minimum label with pointer jumping over the confirmed links, on tables; the
   blocks' links join components of step 3 and are solved on those.

A pair of similarity s shares a bucket with probability 1 - (1 - s^rows)^bands: 0.999993 at 0.8
with the default 30 bands of 5 rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.text import as_bytes, hash_words, mix
from cinerank.session import materialize

BANDS, ROWS = 30, 5
SKETCH_LONGS = 8
BLOCK = 1024  # members of a block; blocks also hold BLOCK_SHINGLES shingles at most, but for one member
BLOCK_SHINGLES = 1_000_000
SMALL_ROWS = 1_000_000

_rng = np.random.Generator(np.random.PCG64(5))
_MULT = (_rng.integers(0, 1 << 31, 4096, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
_C = np.uint64(0xD6E8FEB86659FD93)

SIGNATURE_SCHEMA = ("doc_id long, text_key long, n_shingles long, f1 long, f2 long, bands array<long>, "
                    + ", ".join(f"s{i} long" for i in range(SKETCH_LONGS)))


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Distinct k-word shingle hashes (ascending) of each text; a shorter text is one shingle."""
    h, counts = hash_words(texts, "space")
    n = len(h)
    roll = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        roll[:n - j] = roll[:n - j] * _C + h[j:]
    roll = mix(roll)
    first = np.concatenate([[0], np.cumsum(counts)]).tolist()
    out = []
    for d, c in enumerate(counts.tolist()):
        a = first[d]
        if c >= k:
            s = np.sort(roll[a:a + c - k + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif c:
            one = np.uint64(c)
            with np.errstate(over="ignore"):
                for w in h[a:a + c]:
                    one = one * _C + w
            out.append(mix(np.array([one ^ np.uint64(0x5BD1E995)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def min_hashes(s: np.ndarray, k: int) -> np.ndarray:
    """k MinHash samples (uint32) of a non-empty set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(k, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(x), 2048):  # a matrix of k x 2048 at most
        np.minimum(low, (_MULT[:k, None] * x[None, a:a + 2048]).min(axis=1), out=low)
    return low


def _signatures(k: int, bands: int, rows: int):
    n_hash = bands * rows
    bits = SKETCH_LONGS * 64
    salt = mix(np.arange(1, n_hash + 1, dtype=np.uint64))
    band_salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(7919))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                sets = shingle_sets(as_bytes(b.column(2)), k)
                n = len(sets)
                size = np.array([len(s) for s in sets], dtype=np.int64)
                low = np.zeros((n, n_hash), dtype=np.uint32)
                f = np.zeros((2, n), dtype=np.uint64)
                for d, s in enumerate(sets):
                    if len(s):
                        low[d] = min_hashes(s, n_hash)
                        f[0, d] = mix(s).sum(dtype=np.uint64)
                        f[1, d] = mix(s ^ _C).sum(dtype=np.uint64)
                sample = mix(low.astype(np.uint64) ^ salt[None, :])
                bit = (sample % np.uint64(bits)).astype(np.int64)
                odd = np.bincount((np.arange(n)[:, None] * bits + bit).ravel(), minlength=n * bits) & 1
                sketch = np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").reshape(n, SKETCH_LONGS)
                key = np.zeros((n, bands), dtype=np.uint64) + band_salt[None, :]
                cells = low.reshape(n, bands, rows).astype(np.uint64)
                for r in range(rows):
                    key = mix(key * _C + cells[:, :, r])
                flat = pa.array(key.view(np.int64).ravel())
                ends = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))])
                flat = flat if (size > 0).all() else pa.array(key[size > 0].view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(size), pa.array(f[0].view(np.int64)),
                     pa.array(f[1].view(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
                    + [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_LONGS)],
                    names=["doc_id", "text_key", "n_shingles", "f1", "f2", "bands"]
                    + [f"s{i}" for i in range(SKETCH_LONGS)])

    return run


def sketch_limit(threshold: int, n_hash: int) -> int:
    """XOR population count that a pair at the threshold stays under but for about one case in 10^7.

    Differing samples D are binomial; each flips two bits, one per side; 2 D random flips of an
    n-bit map leave n / 2 (1 - (1 - 2 / n)^(2 D)) odd bits on average, with a variance below n / 4.
    """
    n = SKETCH_LONGS * 64
    miss = 1 - threshold / 100
    worst = n_hash * miss + 5.2 * (n_hash * miss * (1 - miss)) ** 0.5
    mean = n / 2 * (1 - (1 - 2 / n) ** (2 * worst))
    return int(mean + 2.5 * (n / 4) ** 0.5)


def _verify(k: int, threshold: int):
    """Confirms pairs on their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                a, c = b.column(0).to_pylist(), b.column(1).to_pylist()
                texts = dict(zip(a, as_bytes(b.column(2)))) | dict(zip(c, as_bytes(b.column(3))))
                sets = dict(zip(texts, shingle_sets(list(texts.values()), k)))
                keep = []
                for x, y in zip(a, c):
                    both = np.sort(np.concatenate([sets[x], sets[y]]))
                    common = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * common >= threshold * (len(both) - common))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keep)], names=["a", "b", "ok"])

    return run


def _joins(sets: list[np.ndarray], root: np.ndarray, side: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Pairs of roots that confirmed links between the sides 0 and 1 (or within 0) join, a spanning set.

    Every pair of two components has a member outside the block's largest component, so only those
    are compared with all.
    """
    _, of_root = np.unique(root, return_inverse=True)
    few = np.flatnonzero(of_root != np.bincount(of_root).argmax())
    size = np.array([len(x) for x in sets])
    of = np.repeat(np.arange(len(sets)), size)
    _, slot, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[slot] > 1  # other shingles are in no intersection
    number = np.cumsum(count > 1) - 1
    of, slot = of[shared], number[slot[shared]]
    common = np.zeros((len(few), len(sets)), dtype=np.float32)  # exact: counts are far below 2^24
    order = np.argsort(slot, kind="stable")
    of, slot = of[order], slot[order]
    for a in range(0, int(slot[-1]) + 1 if len(slot) else 0, 4096):
        lo, hi = np.searchsorted(slot, [a, a + 4096])
        x = np.zeros((len(sets), 4096), dtype=np.float32)
        x[of[lo:hi], slot[lo:hi] - a] = 1
        common += x[few] @ x.T
    union = size[few, None] + size[None, :] - common
    linked = (100 * common.astype(np.float64) >= threshold * union) & (root[few, None] != root[None, :])
    linked &= (side[few, None] != side[None, :]) | (side.max() == 0)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    out = []
    for i, j in zip(*np.nonzero(linked)):
        x, y = int(root[few[i]]), int(root[j])
        a, b = find(x), find(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((min(x, y), max(x, y)))
    return out


def _block_links(k: int, threshold: int):
    """Joins of different components within one block pair of a bucket."""

    def run(t: pa.Table) -> pa.Table:
        own = t.column("s")[0].as_py()
        root, side = t.column("root").to_numpy(), (t.column("side").to_numpy() != own).astype(np.int8)
        out = []
        if (root != root[0]).any():
            out = _joins(shingle_sets(as_bytes(t.column("text").combine_chunks()), k), root, side, threshold)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return run


def components(links: DataFrame, name: str = "near-dup", small_rows: int = SMALL_ROWS) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); root is the component's smallest node.

    Minimum label over neighbours, then over the label's own label; every round is written as a
    table, so lost executors only repeat one round.  Up to ``small_rows`` links the labels (16
    bytes each) are broadcast, beyond they are joined by shuffles; the result is the same.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")) \
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct()
    both = materialize(both, f"{name}-links")
    n = both.count()
    near_all = F.broadcast if n <= small_rows else lambda df: df
    files = max(1, n // 250_000)
    label = materialize(both.groupBy("node").agg(F.min("other").alias("m"))
                        .select("node", F.least("node", "m").alias("root")).coalesce(files) if n <= small_rows else
                        both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")),
                        f"{name}-label")
    while True:
        near = both.join(near_all(label.select(F.col("node").alias("other"), "root")), "other") \
            .groupBy("node").agg(F.min("root").alias("near"))
        step = near.join(near_all(label), "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = step.join(near_all(label.select(F.col("node").alias("root"), F.col("root").alias("far"))), "root") \
            .select("node", "old", F.least("root", "far").alias("root"))
        moved = materialize(jump.coalesce(files) if n <= small_rows else jump, f"{name}-label")
        if moved.filter("root <> old").isEmpty():
            return moved.select("node", "root")
        label = moved.select("node", "root")


def _compare(active: DataFrame, texts: DataFrame, shingle: int, threshold: int, block: int) -> DataFrame:
    """Joins (a, b) of components among the members of each bucket, by bounded block pairs.

    active: key, node, turn, n, root and the bucket's largest component ``major``.  Its members are
    cut into p parts, the *few* others into q parts (by member hash); block pairs are few x few
    (s <= t < q) and few x major (t >= q), never major x major, whose members are joined already.
    """
    few = F.col("root") != F.col("major")

    def parts(own):
        return F.greatest(F.lit(1), F.ceil(F.sum(F.when(own, 1).otherwise(0)) / block),
                          F.ceil(F.sum(F.when(own, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).cast("int")

    cuts = active.groupBy("key").agg(parts(few).alias("q"), parts(~few).alias("p"))
    pair = lambda s, t: F.struct(s.alias("s"), t.alias("t"))
    side = F.when(few, F.pmod("turn", F.col("q"))).otherwise(F.col("q") + F.pmod("turn", F.col("p"))).cast("int")
    with_few = F.transform(F.sequence(F.lit(0), F.col("q") - 1),
                           lambda o: pair(F.least(o, F.col("side")), F.greatest(o, F.col("side"))))
    with_major = F.transform(F.sequence(F.col("q"), F.col("q") + F.col("p") - 1), lambda o: pair(F.col("side"), o))
    dealt = active.join(cuts, "key").withColumn("side", side) \
        .withColumn("x", F.explode(F.when(few, F.concat(with_few, with_major)).otherwise(with_few))) \
        .select("key", "node", "root", "side", "x.s", "x.t").join(texts, "node")
    return dealt.groupBy("key", "s", "t").applyInArrow(_block_links(shingle, threshold), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    threshold: int = 80, bands: int = BANDS, rows: int = ROWS,
                    block: int = BLOCK) -> DataFrame:
    """doc_id, text_key, n_shingles, class_id, component_id, kept, root per document row.

    Words are ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased); a document's set holds its distinct
    ``shingle``-word shingles, or the whole sequence as one if it has fewer words.  Documents with
    100 * intersection >= threshold * union are linked; ``component_id`` is the smallest id
    reachable, ``class_id`` is the same for equal sets.  Null and wordless texts have an empty set
    and are linked with nothing.  Repeated rows fall into one class and all carry the id; a null id
    is no smallest id (a group of null ids only has a null component).  ``kept`` is doc_id =
    component_id (null-safe).  ``text_key`` is xxhash64 of the text.  ``root`` names the group also
    where ids repeat or are null (null for empty sets).  An empty table gives no rows; other columns are
    not read.
    """
    sketch = [f"s{i}" for i in range(SKETCH_LONGS)]
    text = F.col(text_col).cast("string")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    signed = materialize(plain.mapInArrow(_signatures(shingle, bands, rows), SIGNATURE_SCHEMA)
                         .withColumn("node", F.xxhash64("f1", "f2", "n_shingles")), "near-dup-signatures")
    filled = signed.filter("n_shingles > 0")
    reps = materialize(
        filled.groupBy("node").agg(F.min("doc_id").alias("first_id"),
                                   F.min_by(F.struct("doc_id", "text_key"), F.struct("doc_id", "text_key")).alias("own"),
                                   F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
                                   *[F.first(c).alias(c) for c in sketch]), "near-dup-classes")
    buckets = reps.select("node", "n", F.explode("bands").alias("key"))
    crowded = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    member = materialize(buckets.join(crowded, "key").withColumn("turn", F.xxhash64("key", "node")), "near-dup-members")
    limit = sketch_limit(threshold, bands * rows)

    def screened(pairs: DataFrame) -> DataFrame:
        """Candidate pairs (a, b) that pass size and sketch."""
        side = lambda x: reps.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"),
                                     *[F.col(c).alias(f"{x}_{c}") for c in sketch])
        apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in sketch), F.lit(0))
        return pairs.join(side("a"), "a").join(side("b"), "b").filter(
            (apart <= limit) & (100 * F.least("a_n", "b_n") >= threshold * F.greatest("a_n", "b_n"))).select("a", "b")

    def texts_of(nodes: DataFrame, name: str) -> DataFrame:
        """(node, text) of class representatives."""
        own = reps.join(nodes, "node").select("node", F.col("own.doc_id").alias("i"), F.col("own.text_key").alias("k"))
        found = plain.join(own, plain["doc_id"].eqNullSafe(own["i"]) & (plain["text_key"] == own["k"])) \
            .groupBy("node").agg(F.first("text").alias("text"))
        return materialize(found, f"near-dup-{name}-texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs, "near-dup-pairs")
        texts = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "star")
        a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        ab = a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        checked = ab.select("a", "b", "ta", "tb").mapInArrow(_verify(shingle, threshold), "a long, b long, ok boolean")
        return checked.filter("ok").select("a", "b")

    lead = member.groupBy("key").agg(F.min(F.struct("turn", "node")).alias("lead")).select("key", F.col("lead.node").alias("leader"))
    led = member.join(lead, "key").filter("node <> leader").select("key", "node", "turn", "n", "leader")
    pairs = led.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    label = components(confirmed(screened(pairs)))

    rooted = led.join(label, "node", "left").select("key", "node", "turn", "n", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("key") \
        .agg(F.max_by("root", "m").alias("major"), F.count(F.lit(1)).alias("roots")).filter("roots > 1").select("key", "major")
    active = materialize(rooted.join(mixed, "key"), "near-dup-active")
    if not active.isEmpty():
        joins = materialize(_compare(active, texts_of(active.select("node").distinct(), "rest"), shingle, threshold, block),
                            "near-dup-joins")
        if not joins.isEmpty():
            over = components(joins, "near-dup-over").select(F.col("node").alias("root"), F.col("root").alias("top"))
            names = label.unionByName(over.select(F.col("root").alias("node"), "root").join(
                label.select("node"), "node", "left_anti"))  # a component of one has no label yet
            label = materialize(names.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root")),
                                "near-dup-label")

    classes = reps.select("node", "first_id").join(label, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = classes.join(smallest, "root").select("node", "root", "component_id")
    rows_ = signed.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows_.select("doc_id", "text_key", "n_shingles", F.col("node").alias("class_id"),
                        component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "root")


def remove_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one of each duplicate group, the smallest id's.

    Null ids come last; of several texts with the smallest id (or with null ids only) one stays, by the
    text's hash.  Rows are met again by id and text, so of rows that repeat both, one stays; texts
    without words all stay.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}")
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    kept = materialize(found.filter("kept").groupBy("doc_id", "text_key").agg(
        F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("times"), F.first("root").alias("root")), "near-dup-kept")
    one = kept.filter("n > 0").groupBy("root").agg(F.min(F.struct("doc_id", "text_key", "n", "times")).alias("own"))
    stay = materialize(one.select("own.*").unionByName(kept.filter("n = 0").drop("root")), "near-dup-stay")
    keyed = plain.withColumn("__i", id_.cast("long")).withColumn("__k", F.xxhash64(text.cast("string")))

    def met(own: DataFrame) -> DataFrame:
        return keyed.join(own, keyed["__i"].eqNullSafe(own["doc_id"]) & (keyed["__k"] == own["text_key"]), "left_semi")

    again = stay.filter("n > 0 and times > 1")
    if again.isEmpty():
        out = met(stay)
    else:
        out = met(stay.filter("n = 0 or times = 1")).unionByName(met(again).dropDuplicates(["__i", "__k"]))
    return out.drop("__i", "__k").toDF(*names)
