"""Language-model scoring by deleted interpolation.

P(w | v) = a0[b] / (V + 1) + a1[b] * c(w) / N + a2[b] * c(v w) / c(v), where b is the bucket of
the context's frequency c(v) (powers of two) and c, N, V are training counts; a context never
seen in training has no pair estimate and uses c(w) / N in its place.  The weights
a[b] are learned by expectation-maximisation on held-out counts: the *slice* documents
(a part of the training documents) supply the events, and the maximum-likelihood estimates
they are weighed with are those with the slice's own counts deleted.

Data flow (no vocabulary or n-gram table is ever broadcast or collected):

1. texts become *chunks* of about ``CHUNK_BYTES`` (local word ids plus the local vocabulary's
   hashes), written once; each chunk is wholly slice, other training or held-out text;
2. every chunk sends its distinct words and word pairs (64-bit hashes, byte planes of sorted
   differences) with its counts to at most ``FAN`` hash ranges.  Up to ``FAN`` chunks meet a range at
   once; the range merges their counts and answers every chunk with its keys' totals, in the chunk's own
   key order, so answers are small integers without keys.  More chunks meet in levels: a group of
   chunks merges each range, cuts it into ``FAN`` smaller ones and sends those on like a chunk, and
   answers come back the same way.  So a chunk or group has ``FAN`` rows on every level, and all
   rows grow with the input.  A frequent word is one key per chunk, so nothing is skewed;
3. the slice chunks meet their answers and give a histogram of (bucket, log10 of both
   estimates, to 1/50); its size is fixed, and EM runs on it;
4. all chunks meet their answers and every document is scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.text import as_bytes, hash_words, mix, pack_sorted, unpack_sorted
from cinerank.session import materialize

CHUNK_BYTES = 3 << 20
FAN = 512  # hash ranges that one chunk or group sends to, and chunks or groups that meet in one
RANGE_BYTES = 2 << 20  # of keys that a last range merges, about
CONTEXT_BUCKETS = 24
BINS = 50  # histogram bins per decade
FLOOR = -12.0  # log10 below which an estimate counts as zero
END = np.uint64(0x1F3D5B79A2C4E681)  # the end token's hash; texts also begin in its context
SLICE, TRAIN, HELD_OUT = 1, 0, 2

CHUNK_SCHEMA = "chunk string, role int, n_docs int, ids binary, sizes binary, words binary, vocab binary"


def crc_of_id(column: str) -> F.Column:
    """crc32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def _zip(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unzip(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=dtype)


def _planes(a: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: four of them, or eight if a number needs more."""
    width = 4 if not len(a) or int(a.max()) < 1 << 32 else 8
    return bytes([width]) + _zip(np.ascontiguousarray(a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T))


def _from_planes(raw: bytes) -> np.ndarray:
    planes = _unzip(raw[1:], np.uint8).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{raw[0]}").ravel()


def _chunk_row(rows: list[tuple], role: int) -> tuple:
    h, counts = hash_words([t for _, t in rows], "space")
    ends = np.cumsum(counts + 1) - 1
    words = np.full(len(h) + len(rows), END, dtype=np.uint64)
    inside = np.ones(len(words), dtype=bool)
    inside[ends] = False
    words[inside] = h
    vocab, local = np.unique(words, return_inverse=True)
    ids = np.array([i for i, _ in rows], dtype=object)
    known = np.array([i is not None for i in ids])
    packed = np.where(known, ids, 0).astype("<i8")
    key = f"{role}-{packed[0]}-{len(rows)}-{zlib.crc32(words.tobytes()):08x}-{zlib.crc32(packed.tobytes()):08x}"
    return (key, role, len(rows), _zip(np.concatenate([packed, known.astype("<i8")])), _zip(counts + 1),
            _planes(local), pack_sorted(vocab))


def _to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_: dict[int, list] = {}
    size: dict[int, int] = {}
    names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]
    task = TaskContext.get().partitionId()  # equal chunks of two tasks keep two names
    seen: dict[str, int] = {}

    def out(role: int) -> pa.RecordBatch:
        row = list(_chunk_row(open_.pop(role), role))
        seen[row[0]] = seen.get(row[0], 0) + 1
        row[0] = f"{row[0]}-{task}-{seen[row[0]]}"
        size.pop(role)
        types = [pa.string(), pa.int32(), pa.int32()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    for b in batches:
        for i, role, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), as_bytes(b.column(2))):
            open_.setdefault(role, []).append((i, t))
            size[role] = size.get(role, 0) + len(t or b"") + 1
            if size[role] >= CHUNK_BYTES:
                yield out(role)
    for role in list(open_):
        yield out(role)


def _pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a word pair (the low bit tells pairs from words)."""
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + word) | np.uint64(1)


def _chunk_keys(words: bytes, vocab: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, local ids, pair keys ascending, place of each token's pair among them, local context ids)."""
    v = unpack_sorted(vocab)
    local = _from_planes(words).astype(np.int64)
    context = np.empty(len(local), dtype=np.int64)
    end = int(np.searchsorted(v, END))
    if len(local):
        context[0] = end
        context[1:] = local[:-1]
    number, pair_at = np.unique(context * len(v) + local, return_inverse=True)
    pair = _pair_hash(v[number // len(v)], v[number % len(v)]) if len(v) else number.astype(np.uint64)
    order = np.argsort(pair)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return v & ~np.uint64(1), local, pair[order], place[pair_at], context


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time (a row is megabytes)."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _range_cuts(keys: np.ndarray, first: int, fan: int, level: int) -> np.ndarray:
    """Ascending keys of range ``first`` (of fan^level) are cut into its ``fan`` ranges of the next level."""
    whole = fan ** (level + 1)
    edges = np.array([(first * fan + j) * (1 << 64) // whole for j in range(1, fan)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _pieces(unit: str, first: int, fan: int, level: int, keys: np.ndarray, totals: np.ndarray, slices: np.ndarray) -> pa.RecordBatch:
    """What a chunk or group sends: a row for each of its ranges that holds a key."""
    cut = _range_cuts(keys, first, fan, level)
    own = [(k, cut[k], cut[k + 1]) for k in np.flatnonzero(np.diff(cut)).tolist()]
    return pa.RecordBatch.from_arrays(
        [pa.array([unit] * len(own), pa.string()), pa.array([first * fan + k for k, _, _ in own], pa.int64()),
         pa.array([pack_sorted(keys[a:e]) for _, a, e in own], pa.binary()),
         pa.array([_planes(totals[a:e]) for _, a, e in own], pa.binary()),
         pa.array([_planes(slices[a:e]) for _, a, e in own], pa.binary())], names=["unit", "range", "keys", "totals", "slices"])


def _requests(fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in _rows(b):
                wk, local, pk, place, _ = _chunk_keys(r["words"], r["vocab"])
                keys = np.concatenate([wk, pk])
                n = np.concatenate([np.bincount(local, minlength=len(wk)), np.bincount(place, minlength=len(pk))])
                by = np.argsort(keys, kind="stable")
                keys, n = keys[by], n[by] * (r["role"] != HELD_OUT)
                yield _pieces(r["chunk"], 0, fan, 0, keys, n, n * (r["role"] == SLICE))

    return run


PIECE_SCHEMA = "unit string, range long, keys binary, totals binary, slices binary"
ANSWER_SCHEMA = "unit string, range long, totals binary, slices binary, tokens long, types long"


def _merged(sent: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, first key of each row, place of every row's keys among the merged ones, merged keys, totals, slices)."""
    rows = sent.select(["unit", "range"]).to_pylist()
    keys = [unpack_sorted(raw.as_py()) for raw in sent.column("keys")]
    first = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    at = at.astype(np.int32 if len(every) < 1 << 31 else np.int64)

    def add(name: str) -> np.ndarray:
        total = np.zeros(len(every), dtype=np.int64)
        for i, raw in enumerate(sent.column(name)):
            total[at[first[i]:first[i + 1]]] += _from_planes(raw.as_py()).astype(np.int64)  # a row's keys differ
        return total

    return rows, first, at, every, add("totals"), add("slices")


def _replies(rows: list[dict], first: np.ndarray, at: np.ndarray, every: np.ndarray, total: np.ndarray, part: np.ndarray,
             last: bool) -> pa.Table:
    """The merged counts for each row's keys, in its own order; the last level also counts tokens and types once."""
    word = every & np.uint64(1) == 0
    out = []
    for i, r in enumerate(rows):
        mine = at[first[i]:first[i + 1]]
        facts = (int(total[word].sum()), int((total[word] > 0).sum())) if last and i == 0 else (0, 0)
        out.append((r["unit"], r["range"], _planes(total[mine]), _planes(part[mine]), *facts))
    types = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["unit", "range", "totals", "slices", "tokens", "types"]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names=names)


def _answer(sent: pa.Table) -> pa.Table:
    """The last level: totals over all chunks for the keys of one range."""
    return _replies(*_merged(sent), last=True)


def _send_on(fan: int, level: int):
    """A group merges one range and sends it on in smaller ranges."""

    def run(sent: pa.Table) -> pa.Table:
        _, _, _, every, total, part = _merged(sent)
        unit, first = str(sent.column("grp")[0].as_py()), sent.column("range")[0].as_py()
        return pa.Table.from_batches([_pieces(unit, first, fan, level + 1, every, total, part)])

    return run


def _pass_back(sent: pa.Table, back: pa.Table) -> pa.Table:
    """A group gives the answers for its merged range to those who sent it."""
    if not sent.num_rows:
        return _replies_schema()
    rows, first, at, every, _, _ = _merged(sent)
    answers = sorted(back.to_pylist(), key=lambda r: r["range"])
    total = np.concatenate([_from_planes(r["totals"]) for r in answers]).astype(np.int64)
    part = np.concatenate([_from_planes(r["slices"]) for r in answers]).astype(np.int64)
    return _replies(rows, first, at, every, total, part, last=False)


def _replies_schema() -> pa.Table:
    return pa.table({"unit": pa.array([], pa.string()), "range": pa.array([], pa.int64()), "totals": pa.array([], pa.binary()),
                     "slices": pa.array([], pa.binary()), "tokens": pa.array([], pa.int64()), "types": pa.array([], pa.int64())})


def exchange(chunks: DataFrame, n_chunks: int, ranges: int) -> tuple[DataFrame, int, int]:
    """(answers ``unit, range, totals, slices`` for every chunk, training tokens, types).

    ``ranges``: how many ranges the last level should have at least.
    """
    wanted, levels = max(8, n_chunks, ranges), 1
    while FAN ** levels < wanted:
        levels += 1
    fan = min(f for f in range(2, FAN + 1) if f ** levels >= wanted)
    sent = chunks.select("chunk", "role", "words", "vocab").mapInArrow(_requests(fan), PIECE_SCHEMA)
    tables, units = [], n_chunks
    for level in range(levels - 1):
        groups = max(1, -(-units // fan))
        sent = materialize(sent, "lm-pieces").withColumn("grp", F.pmod(F.xxhash64("unit"), F.lit(groups)))
        tables.append(sent)
        sent, units = sent.groupBy("grp", "range").applyInArrow(_send_on(fan, level), PIECE_SCHEMA), groups
    answers = materialize(sent.groupBy("range").applyInArrow(_answer, ANSWER_SCHEMA), "lm-answers")
    size = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    for sent in reversed(tables):
        back = answers.select(F.col("unit").cast("long").alias("grp"), F.floor(F.col("range") / fan).cast("long").alias("of"),
                              "range", "totals", "slices")
        answers = materialize(sent.groupBy("grp", "range").cogroup(back.groupBy("grp", "of"))
                              .applyInArrow(_pass_back, ANSWER_SCHEMA), "lm-answers")
    return answers, int(size[0]), int(size[1])


def _counts_of(r: dict) -> tuple[np.ndarray, ...]:
    """Per token of a chunk: c(word), c(context), c(pair), and the same within the slice."""
    wk, local, pk, place, context = _chunk_keys(r["words"], r["vocab"])
    answers = sorted(r["answers"], key=lambda a: a["range"])
    total = np.concatenate([_from_planes(a["totals"]) for a in answers]).astype(np.float64)
    part = np.concatenate([_from_planes(a["slices"]) for a in answers]).astype(np.float64)
    by = np.argsort(np.concatenate([wk, pk]), kind="stable")
    back = np.empty(len(by), dtype=np.int64)
    back[by] = np.arange(len(by))
    word_at, pair_at = back[:len(wk)], back[len(wk):]
    return (total[word_at][local], total[word_at][context], total[pair_at][place],
            part[word_at][local], part[word_at][context], part[pair_at][place])


def _bucket_of(context_count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context_count + 1).astype(np.int64), CONTEXT_BUCKETS - 1)


def _histogram(n_deleted: float):
    """Events of the slice: (context bucket, bin of pair estimate, bin of word estimate) -> count."""
    side = int(-FLOOR * BINS) + 2

    def bins(p: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            b = np.rint((np.log10(p) - FLOOR) * BINS)
        return np.where(p > 0, np.clip(b, 0, side - 2), -1).astype(np.int64) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in _rows(b):
                w, v, p, ws, vs, ps = _counts_of(r)
                w, v, p = w - ws, v - vs, p - ps  # the slice's own counts are deleted
                word = w / max(n_deleted, 1.0)
                pair = np.divide(p, v, out=word.copy(), where=v > 0)
                cell = (_bucket_of(v) * side + bins(pair)) * side + bins(word)
                cells, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["cell", "n"])

    return run


def learn_weights(cells: np.ndarray, n: np.ndarray, types: int, rounds: int = 50) -> np.ndarray:
    """EM for the mixture weights (CONTEXT_BUCKETS x 3: uniform, word, pair) on the event histogram."""
    side = int(-FLOOR * BINS) + 2
    bucket, pair, word = cells // side // side, cells // side % side, cells % side
    value = lambda b: np.where(b > 0, 10.0 ** ((b - 1) / BINS + FLOOR), 0.0)
    parts = np.stack([np.full(len(cells), 1.0 / (types + 1)), value(word), value(pair)], 1)
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[bucket] * parts
        share /= share.sum(1, keepdims=True)
        sums = np.full((CONTEXT_BUCKETS, 3), 1e-3)  # keeps every weight above zero
        for k in range(3):
            sums[:, k] += np.bincount(bucket, n * share[:, k], CONTEXT_BUCKETS)
        weights = sums / sums.sum(1, keepdims=True)
    return weights


SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(weights: np.ndarray, tokens: int, types: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in _rows(b):
                w, v, p = _counts_of(r)[:3]
                base = np.log10((w + 1) / float(tokens + types + 1))
                a = weights[_bucket_of(v)]
                word = w / max(tokens, 1)
                pair = np.divide(p, v, out=word.copy(), where=v > 0)
                model = np.log10(a[:, 0] / (types + 1) + a[:, 1] * word + a[:, 2] * pair)
                sizes = _unzip(r["sizes"], "<i8")
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                ids, known = _unzip(r["ids"], "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64(), mask=known == 0), pa.array([r["role"] == HELD_OUT] * len(ids)),
                    pa.array(sizes, pa.int64()), pa.array(np.add.reduceat((w > 0).astype(np.int64), first)),
                    pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(model, first)),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out=None,
                    em_slice=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document row.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) and one end.  ``held_out`` (a
    condition, default crc32(id) % 7 = 2) marks rows the model doesn't learn from, ``em_slice``
    (default crc32(id) % 7 = 4) the training rows that the mixture weights are learned on.
    ``base_score`` sums log10((c + 1) / (N + V + 1)), ``score`` is the model's log10
    probability.  Null and empty texts are one end token; repeated rows are counted and scored each;
    a null id is kept; without training rows all counts are zero and the scores uniform; an empty
    table gives no rows; other columns are not read.
    """
    part = crc_of_id(id_col) % 7
    out = part == 2 if held_out is None else held_out
    em = part == 4 if em_slice is None else em_slice
    role = F.when(out, HELD_OUT).when(em, SLICE).otherwise(TRAIN)
    rows = docs.select(F.col(id_col).cast("long").alias("i"), role.cast("int").alias("r"),
                       F.col(text_col).cast("string").alias("t"))
    chunks = materialize(rows.mapInArrow(_to_chunks, CHUNK_SCHEMA), "lm-chunks")
    total, n_chunks = chunks.agg(F.coalesce(F.sum(F.length("words") + F.length("vocab")), F.lit(0)), F.count(F.lit(1))).first()
    answers, tokens, types = exchange(chunks, int(n_chunks), int(total // RANGE_BYTES))

    def met(own: DataFrame) -> DataFrame:
        back = answers.groupBy("unit").agg(F.collect_list(F.struct("range", "totals", "slices")).alias("answers"))
        return own.join(back.withColumnRenamed("unit", "chunk"), "chunk")  # at most FAN answers a chunk

    own = met(chunks.filter(F.col("role") == SLICE))
    slice_tokens = chunks.filter(F.col("role") == SLICE).mapInArrow(_n_tokens, "n long") \
        .agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cells = own.mapInArrow(_histogram(float(tokens - slice_tokens)), "cell long, n long") \
        .groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # at most buckets x bins x bins cells
    weights = learn_weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(np.float64), types)
    scored = met(chunks).mapInArrow(_score(weights, tokens, types), SCORE_SCHEMA)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))


def _n_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(_unzip(x, "<i8").sum()) for x in b.column("sizes").to_pylist()], pa.int64())], names=["n"])
