"""Benchmark decontamination: suffix arrays over the training texts, searched by every test window.

Each task turns its documents into shards of a few million words and sorts the word
suffixes of a shard (prefix doubling, only as deep as a window).  Every distinct window of the
test items then narrows an interval of the suffix array word by word with a binary search; the
interval at the window length holds all verbatim occurrences.  An occurrence narrows the interval
of its window in the suffix array of the items; the depth at which it leaves is its longest
match.  No document is shuffled, and the items take memory in proportion to their words.

The test items go to every task when their text is under ``max_item_bytes`` (checked);
a larger benchmark is worked in slices of that size and the slices' hits are merged.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.text import as_bytes, hash_words
from cinerank.session import materialize

WINDOW = 13
SHARD_WORDS = 1_000_000  # a shard's arrays take about 100 bytes a word
SCHEMA = ("row_key long, doc_id long, n_words long, n_hit long, spans array<long>, items array<string>, "
          "longest_match long, longest_start long")


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``words`` (uint64, 0 ends a text) sorted by their next ``depth`` words at least.

    Positions and ranks are 32-bit numbers where the words are fewer than 2^31.
    """
    n = len(words)
    whole = np.int32 if n < (1 << 31) - 1 else np.int64
    order = np.argsort(words, kind="stable").astype(whole)
    ranked = words[order]
    new = np.ones(n, dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if n and ranked[0] == 0:
        new[: np.searchsorted(ranked, 1)] = True  # text ends need no order among themselves
    del ranked
    places = np.arange(n, dtype=whole)
    head = np.maximum.accumulate(np.where(new, places, whole(0)))
    rank = np.zeros(n + 1, dtype=whole)
    rank[order] = head + 1
    step = 1
    while step < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        pos = order[at]
        key = (rank[pos].astype(np.uint64) << np.uint64(32)) | rank[np.minimum(pos + whole(step), whole(n))].astype(np.uint64)
        by = np.argsort(key, kind="stable")
        order[at] = pos[by]
        key = key[by]
        new[at[1:]] = key[1:] != key[:-1]
        new[at[0]] = True
        head = np.maximum.accumulate(np.where(new, places, whole(0)))
        rank[order[at]] = head[at] + 1
        step *= 2
    return order


class TestSuffixes:
    """The test items' words in one array, its suffix array, and the distinct windows that begin the suffixes.

    Windows are offsets into ``flat`` (a 0 ends each item), so memory grows with the words of the items.
    """

    __test__ = False  # not a test class, whatever pytest thinks of its name

    def __init__(self, item_ids: list[str], texts: list[bytes | None], window: int) -> None:
        h, counts = hash_words(texts, "alnum")
        begin = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int64)
        self.flat = np.zeros(int(begin[-1]), dtype=np.uint64)
        inside = np.ones(len(self.flat), dtype=bool)
        inside[begin[1:] - 1] = False
        self.flat[inside] = np.where(h == 0, np.uint64(1), h)
        left = np.repeat(begin[1:] - 1, counts + 1) - np.arange(len(self.flat))  # words up to the item's end
        own = np.repeat(np.arange(len(counts)), counts + 1)
        self.names = item_ids
        # suffixes of a window at least, sorted: those that begin with one window stand together
        order = suffix_array(self.flat, int(max(counts, default=0)) + 1)
        self.sorted = order[left[order] >= window]
        new = np.ones(len(self.sorted), dtype=bool)
        new[1:] = False
        for k in range(window):
            word = self.flat[self.sorted + k]
            new[1:] |= word[1:] != word[:-1]
        head = np.flatnonzero(new)
        self.lo, self.hi = head, np.append(head[1:], len(self.sorted))
        before = self.flat[self.sorted - 1] if len(self.sorted) else self.flat[:0]
        self.before = np.where(self.sorted > 0, before, np.uint64(0))  # the word before each suffix
        turn = np.flatnonzero(np.append(self.before[1:] != self.before[:-1], True)) + 1 if len(before) else head
        self.same_until = turn[np.searchsorted(turn, np.arange(len(self.sorted)), "right")] if len(before) else head
        # items below a window are one window each
        short: dict[bytes, int] = {}
        first, size, of_short, item = [], [], [], []
        for k in np.flatnonzero((counts > 0) & (counts < window)).tolist():
            a, n = int(begin[k]), int(counts[k])
            at = short.setdefault(self.flat[a:a + n].tobytes(), len(short))
            if at == len(first):
                first.append(a)
                size.append(n)
            of_short.append(at + len(head))
            item.append(k)
        self.first = np.concatenate([self.sorted[head], np.array(first, dtype=np.int64)])
        self.sizes = np.concatenate([np.full(len(head), window, dtype=np.int64), np.array(size, dtype=np.int64)])
        n = max(1, len(counts))
        pair = np.unique(np.concatenate([(np.cumsum(new) - 1) * n + own[self.sorted],
                                         np.array(of_short, dtype=np.int64) * n + np.array(item, dtype=np.int64)]))
        self.item = pair % n  # by window; those of window w are item[item_at[w]:item_at[w + 1]]
        self.item_at = np.searchsorted(pair // n, np.arange(len(self.first) + 1))

    def items_of(self, windows: np.ndarray) -> list[str]:
        """Ids of the items that hold any of the windows, sorted."""
        found = {k for w in windows.tolist() for k in self.item[self.item_at[w]:self.item_at[w + 1]].tolist()}
        return sorted({self.names[k] for k in found})


def _bound(words: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: int, q: np.ndarray,
           right: bool) -> np.ndarray:
    """Per query: the first place of its interval whose word at depth d is >= q (> q if right)."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        w = words[order[mid] + d]
        up = (w <= q[open_]) if right else (w < q[open_])
        lo[open_[up]] = mid[up] + 1
        hi[open_[~up]] = mid[~up]


def search_shard(words: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, window) of every window occurrence, and (position, length) of the longest matches there."""
    none = np.zeros(0, dtype=np.int64)
    if not len(words) or not len(tests.first):
        return none, none, none, none
    depth = int(tests.sizes.max())
    order = suffix_array(words, depth)
    first_word = tests.flat[tests.first]
    ranked = words[order]
    lo = np.searchsorted(ranked, first_word, "left")
    hi = np.searchsorted(ranked, first_word, "right")
    live = np.flatnonzero(lo < hi)
    lo, hi = lo[live], hi[live]
    at, of = [none], [none]
    for d in range(1, depth + 1):
        whole = tests.sizes[live] == d  # a window of d words is matched
        n = (hi - lo)[whole]
        which = np.repeat(np.arange(len(n)), n)
        at.append(order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[whole][which]])
        of.append(live[whole][which])
        live, lo, hi = live[~whole], lo[~whole], hi[~whole]
        q = tests.flat[tests.first[live] + d]
        lo = _bound(words, order, lo, hi, d, q, False)
        hi = _bound(words, order, lo, hi, d, q, True)
        keep = lo < hi
        live, lo, hi = live[keep], lo[keep], hi[keep]
        if not len(live):
            break
    found, window = np.concatenate(at), np.concatenate(of)
    ends, lens = _longest(words, found, window, tests)
    return found, window, ends, lens


def _longest(words: np.ndarray, at: np.ndarray, of: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """(position, length) of matches among which is the longest, first one of every text.

    An occurrence narrows the interval of item suffixes that begin with its window, word by word.
    If the same word stands before it and before all suffixes of its interval, the match that
    begins a word earlier is longer, and it needs no look.
    """
    short = of >= len(tests.lo)
    ends, lens = [at[short]], [tests.sizes[of[short]]]
    at, of = at[~short], of[~short]
    lo, hi = tests.lo[of], tests.hi[of]
    before = np.where(at > 0, words[at - 1], np.uint64(0))
    d = int(tests.sizes[0])
    while len(at):
        look = ~((before != 0) & (tests.before[lo] == before) & (tests.same_until[lo] >= hi))
        at, lo, hi, before = at[look], lo[look], hi[look], before[look]
        q = words[at + d]
        new_lo = _bound(tests.flat, tests.sorted, lo, hi, d, q, False)
        new_hi = _bound(tests.flat, tests.sorted, new_lo, hi, d, q, True)
        on = (new_lo < new_hi) & (q != 0)  # the rest matched d words
        ends.append(at[~on])
        lens.append(np.full(int((~on).sum()), d))
        at, lo, hi, before = at[on], new_lo[on], new_hi[on], before[on]
        d += 1
    return np.concatenate(ends), np.concatenate(lens)


def _shard_rows(keys: list, ids: list, texts: list[bytes | None], tests: TestSuffixes) -> pa.RecordBatch:
    h, counts = hash_words(texts, "alnum")
    h = np.where(h == 0, np.uint64(1), h)
    n = len(counts)
    begin = np.concatenate([[0], np.cumsum(counts + 1)])  # a 0 ends each text
    words = np.zeros(int(begin[-1]), dtype=np.uint64)
    inside = np.ones(len(words), dtype=bool)
    inside[begin[1:] - 1] = False
    words[inside] = h
    at, of, end, length = search_shard(words, tests)
    cover = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + tests.sizes[of] if len(of) else at, -1)
    hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    n_hit = np.bincount(np.searchsorted(begin, hit, "right") - 1, minlength=n)[:n]
    doc = np.searchsorted(begin, at, "right") - 1
    items: list[list[str]] = [[] for _ in range(n)]
    pairs = np.unique(np.stack([doc, of], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
    for d in np.unique(pairs[:, 0]).tolist():
        a, e = np.searchsorted(pairs[:, 0], [d, d + 1])
        items[d] = tests.items_of(pairs[a:e, 1])
    spans: list[list[int]] = [[] for _ in range(n)]
    if len(hit):
        cut = np.flatnonzero(np.diff(hit, prepend=-2) > 1)
        last = np.append(cut[1:], len(hit)) - 1
        for a, b in zip(hit[cut].tolist(), hit[last].tolist()):
            d = int(np.searchsorted(begin, a, "right")) - 1
            spans[d] += [a - int(begin[d]), b - int(begin[d]) + 1]  # a run never crosses the 0 between texts
    best = np.zeros(n, dtype=np.int64)
    where = np.full(n, -1, dtype=np.int64)
    if len(end):
        d = np.searchsorted(begin, end, "right") - 1
        by = np.lexsort((-end, length, d))  # longest, then first, of each text comes last
        d, end, length = d[by], end[by], length[by]
        tail = np.flatnonzero(np.append(d[1:] != d[:-1], True))
        best[d[tail]], where[d[tail]] = length[tail], end[tail] - begin[d[tail]]
    return pa.RecordBatch.from_arrays([
        pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64()),
        pa.array(n_hit, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
        pa.array(items, pa.list_(pa.string())),
        pa.array(best, pa.int64()), pa.array(where, pa.int64(), mask=where < 0),
    ], names=["row_key", "doc_id", "n_words", "n_hit", "spans", "items", "longest_match", "longest_start"])


def _scan(shared, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(*shared.value, window)
        keys: list = []
        ids: list = []
        texts: list[bytes | None] = []
        size = 0
        for b in batches:
            for k, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), as_bytes(b.column(2))):
                if texts and size + len(t or b"") > 6 * SHARD_WORDS:
                    yield _shard_rows(keys, ids, texts, tests)
                    keys, ids, texts, size = [], [], [], 0
                keys.append(k)
                ids.append(i)
                texts.append(t)
                size += len(t or b"")
        if texts:
            yield _shard_rows(keys, ids, texts, tests)

    return run


def _tests(items: DataFrame, item_id: str, item_text: str, max_item_bytes: int) -> tuple[DataFrame, int]:
    """(i, t) of the usable items, and in how many slices they are to be shared."""
    tests = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("string").alias("t")) \
        .filter("i is not null and t is not null")
    total = tests.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    return tests, max(1, math.ceil(total / max_item_bytes))


def _share(tests: DataFrame):
    """One slice of the items for every task; ``_tests`` bounds its bytes."""
    own = tests.collect()
    return tests.sparkSession.sparkContext.broadcast(([r.i for r in own], [r.t.encode() for r in own]))


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, one_in: int = 20,
                  max_item_bytes: int = 16 << 20) -> DataFrame:
    """Per document row: words, words inside verbatim occurrences of test windows, items, longest match.

    A window is ``window`` consecutive words of an item (A-Z lower-cased; a shorter item is one
    window).  ``spans`` lists the hit word ranges (start, end, ...); ``contaminated`` holds when
    ``n_hit > 0`` and ``one_in * n_hit >= n_words``.  Null and empty texts have no words and are
    clean; null, empty and wordless items have no window; repeated document rows give one row each;
    repeated items count once per id; other columns are not read.  No documents or no items: no
    hits, and as many rows as documents.
    """
    tests, slices = _tests(items, item_id, item_text, max_item_bytes)
    rows = docs.select(F.lit(0).cast("long").alias("k"), F.col(id_col).cast("long").alias("d"),
                       F.col(text_col).cast("string").alias("t"))
    if slices > 1:  # a row number that stays the same over the slices
        rows = materialize(rows.withColumn("k", F.monotonically_increasing_id()), "decontaminate-docs")
    found = None
    for s in range(slices):
        own = tests.filter(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == s)
        part = rows.mapInArrow(_scan(_share(own), window), SCHEMA)
        found = part if found is None else found.unionByName(part)
    if slices > 1:
        found = _merge(found)
    return found.drop("row_key").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words")))


def _merge(found: DataFrame) -> DataFrame:
    """One row per document row from the rows of all slices (their number bounds each group)."""
    merged = found.groupBy("row_key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("raw"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max(F.struct("longest_match", (-F.col("longest_start")).alias("at"))).alias("best"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, hits = [], []
            for raw in b.column("raw").to_pylist():
                spans: list[int] = []
                for a, e in sorted(zip(raw[::2], raw[1::2])):
                    if spans and a <= spans[-1]:
                        spans[-1] = max(spans[-1], e)
                    else:
                        spans += [a, e]
                out.append(spans)
                hits.append(sum(spans[1::2]) - sum(spans[::2]))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_key"), b.column("doc_id"), b.column("n_words"), pa.array(hits, pa.int64()),
                 pa.array(out, pa.list_(pa.int64())), b.column("items"), b.column("longest_match"),
                 b.column("longest_start")],
                names=["row_key", "doc_id", "n_words", "n_hit", "spans", "items", "longest_match", "longest_start"])

    flat = merged.select("row_key", "doc_id", "n_words", "raw", "items", F.col("best.longest_match"),
                         (-F.col("best.at")).alias("longest_start"))
    return flat.mapInArrow(join, SCHEMA)


def items_digest(items: F.Column | str) -> F.Column:
    """Lowercase hex SHA-256 of the item ids, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def _filter(shared, window: int, one_in: int, at: int):
    """Passes on the rows whose text (column ``at``) is clean, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(*shared.value, window)

        def clean(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = [t for b in held for t in as_bytes(b.column(at))]
            none = [None] * len(texts)
            rows = _shard_rows(none, none, texts, tests)
            n_words, n_hit = rows.column("n_words").to_numpy(), rows.column("n_hit").to_numpy()
            good = (n_hit == 0) | (one_in * n_hit < n_words)
            for b in held:
                yield b.filter(pa.array(good[:b.num_rows]))
                good = good[b.num_rows:]

        held: list[pa.RecordBatch] = []
        size = 0
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                held.append(b)
                size += b.column(at).nbytes
                if size > 6 * SHARD_WORDS:
                    yield from clean(held)
                    held, size = [], 0
        if held:
            yield from clean(held)

    return run


def remove_contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
                        item_text: str = "text", window: int = WINDOW, one_in: int = 20,
                        max_item_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) whose text is not contaminated.

    Each row is judged by its own text, in place, so nulls and repeats in other columns do not
    matter; see ``contamination`` for the rule and its edge cases.  With a benchmark beyond
    ``max_item_bytes`` rows get a number and meet the merged verdict of all slices.
    """
    names = docs.columns
    keys, at = [f"c{i}" for i in range(len(names))], names.index(text_col)
    plain = docs.toDF(*keys)
    plain = plain.withColumn(keys[at], F.col(keys[at]).cast("string"))
    tests, slices = _tests(items, item_id, item_text, max_item_bytes)
    if slices == 1:
        shared = _share(tests)
        schema = ", ".join(f"{n} {t}" for n, t in plain.dtypes)
        return plain.mapInArrow(_filter(shared, window, one_in, at), schema).toDF(*names)
    keyed = materialize(plain.withColumn("row_key", F.monotonically_increasing_id()), "decontaminate-rows")
    bad = contamination(keyed, items, id_col="row_key", text_col=keys[at], item_id=item_id, item_text=item_text,
                        window=window, one_in=one_in, max_item_bytes=max_item_bytes).filter("contaminated")
    kept = keyed.join(bad.select(F.col("doc_id").alias("row_key")), "row_key", "left_anti")
    return kept.select(*keys).toDF(*names)


def sha256_of(ids: list[str]) -> str:
    """The digest of ``items_digest``, in Python (tests)."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
