"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model is compiled once into arrays of states and arcs over bytes:

* normaliser: a dummy blank in front, U+2581 and blanks to one symbol (an identity character map is
  required);
* pieces: a trie, whose arcs (state, byte) -> state stand in a hash table of arrays;
* byte fallback: arcs for the bytes of a character without a piece.

Their composition with an input is a lattice whose states are (position, last piece); its
tropical shortest path is the encoding.  For unigram models an arc weighs minus its score.  A
byte-pair model's merges are not additive weights, but they are local: a sequence of pieces is
the model's encoding exactly if every two neighbours are what merging gives for their joined
text.  So an arc weighs 0 if its piece may follow the state's last piece and infinity
otherwise; every position then has a single state of finite distance.  Two neighbours are judged by
undoing their merges, latest first: the arc is infinite if on the way two symbols meet across the
boundary whose own merge came earlier.

No piece joins a blank to what stands before it, and some characters are in no piece, so a text
falls into segments (blanks and one word).  The distinct segments of a batch are composed with
the machines together, all at once with numpy, and their paths are gathered back by Arrow;
nothing is kept from batch to batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_BYTES = 1 << 20  # of text encoded together
BLOCK_BYTES = 1 << 16  # of distinct segments composed together
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, raw[at:at + size]
            at += size


class PieceModel:
    """Pieces, scores and types of a model file."""

    def __init__(self, raw: bytes) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.prefix, squeeze, chars, suffix = UNIGRAM, True, True, b"", False
        for number, value in _fields(raw):
            if number == 1:
                own = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                self.pieces.append(own[1].decode())
                self.scores.append(float(np.frombuffer(own[2], "<f4")[0]))
                self.types.append(int(own[3]))
            elif number == 2:
                spec = dict(_fields(value))
                self.kind = int(spec.get(3, UNIGRAM))
                suffix = bool(spec.get(24, 0))
            elif number == 3:
                spec = dict(_fields(value))
                chars, self.prefix, squeeze = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if chars or squeeze or suffix or self.kind not in (UNIGRAM, BPE) or USER in self.types or UNUSED in self.types:
            raise ValueError("only models with an identity normaliser, leading blanks and plain pieces are supported")


class Table:
    """Whole numbers under whole-number keys, by open addressing; looked up for many keys at once."""

    def __init__(self, entries: dict[int, int]) -> None:
        self.bits = max(4, (4 * len(entries)).bit_length())
        self.key, self.value = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, -1, dtype=np.int64)
        slots = self._slot(np.fromiter(entries, dtype=np.int64, count=len(entries))).tolist()
        for at, (key, value) in zip(slots, entries.items()):
            while self.key[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.key[at], self.value[at] = key, value

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def of(self, key: np.ndarray) -> np.ndarray:
        """Values, -1 for unknown keys."""
        at = self._slot(key)
        seen = self.key[at]
        out = np.where(seen == key, self.value[at], -1)
        left = np.flatnonzero((seen != key) & (seen >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            seen = self.key[at[left]]
            hit = seen == key[left]
            out[left[hit]] = self.value[at[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out


class Trie:
    """States of the piece machine: arcs (state, byte) -> state, and the piece that ends at a state."""

    def __init__(self, words: dict[bytes, int]) -> None:
        arcs: dict[int, int] = {}
        piece = [-1]
        for word, i in words.items():
            at = 0
            for byte in word:
                on = arcs.get(at << 8 | byte)
                if on is None:
                    on = arcs[at << 8 | byte] = len(piece)
                    piece.append(-1)
                at = on
            piece[at] = i
        self.next, self.piece = Table(arcs), np.array(piece, dtype=np.int64)
        self.depth = max(map(len, words), default=0)

    def arcs(self, text: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of every piece in the text; ``room``: bytes to the end of a start's segment."""
        at, state = np.arange(len(text)), np.zeros(len(text), dtype=np.int64)
        starts, sizes, found = [], [], []
        for d in range(self.depth):
            inside = room[at] > d
            at, state = at[inside], state[inside]
            state = self.next.of(state << 8 | text[at + d])
            at, state = at[state >= 0], state[state >= 0]
            piece = self.piece[state]
            final = np.flatnonzero(piece >= 0)
            starts.append(at[final])
            sizes.append(np.full(len(final), d + 1))
            found.append(piece[final])
            if not len(at):
                break
        none = [np.zeros(0, dtype=np.int64)]
        return np.concatenate(starts or none), np.concatenate(sizes or none), np.concatenate(found or none)


class Transducer:
    """The compiled machines of one model."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.arc = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == BYTE}
        self.unknown = model.types.index(UNKNOWN)
        if any(BLANK in p.lstrip(BLANK) for p in self.arc):
            raise ValueError("a piece joins a blank to what stands before it")
        chars = {c for p in self.arc for c in p}
        if not chars <= set(self.arc):
            raise ValueError("a character of a piece is no piece")
        self.apart = np.array([c < 32 and chr(c) not in chars for c in range(256)])
        self.rank = np.full(len(model.pieces), -1, dtype=np.int64)  # merge order; characters come first
        self.left, self.right = np.arange(len(model.pieces)), np.arange(len(model.pieces))
        reached = self._compile_merges() if model.kind == BPE else list(self.arc.values())
        plain = {p.replace(BLANK, " ").encode(): i for p, i in self.arc.items()}
        own = set(reached)
        self.trie = Trie({w: i for w, i in plain.items() if i in own})
        self.normal, self.scores = np.array([t == NORMAL for t in model.types]), np.array(model.scores)
        self.of_byte = np.array([self.byte.get(b, -1) for b in range(256)], dtype=np.int64)
        self.text_of = pa.array([self._text_of(i) for i in range(len(model.pieces))], pa.binary())

    def _text_of(self, i: int) -> bytes:
        kind, piece = self.model.types[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == CONTROL else b" \xe2\x81\x87 " if kind == UNKNOWN else piece.replace(BLANK, " ").encode()

    def _compile_merges(self) -> list[int]:
        """Ranks, last merges and pairs of the pieces that merging their own text gives."""
        order = sorted((i for p, i in self.arc.items() if len(p) > 1), key=lambda i: (-self.model.scores[i], i))
        places = {x: r for r, x in enumerate(sorted({self.model.scores[i] for i in order}, reverse=True))}
        for i in order:  # pieces of one score (runs of blanks) have one rank
            self.rank[i] = places[self.model.scores[i]]
        pairs: dict[tuple[int, int], int] = {}
        reached = [i for p, i in self.arc.items() if len(p) == 1]
        for i in order:
            two = self._merge(self.model.pieces[i], 2)
            if len(two) == 2 and all(x in self.arc for x in two):
                a, b = self.arc[two[0]], self.arc[two[1]]
                self.left[i], self.right[i], pairs[a, b] = a, b, i
                reached.append(i)
        self.pairs = Table({a * len(self.rank) + b: i for (a, b), i in pairs.items()})
        return reached

    def _merge(self, text: str, stop: int = 1) -> list[str]:
        """The model's merges on a short text, down to ``stop`` parts."""
        parts = list(text)
        while len(parts) > stop:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                i = self.arc.get(parts[k] + parts[k + 1])
                if i is not None and self.model.scores[i] > best:
                    best, at = self.model.scores[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each arc ``piece`` has weight 0 after the piece ``last`` (-1: the start) in a byte-pair model."""
        good = np.ones(len(last), dtype=bool)
        open_ = np.flatnonzero(last >= 0)
        a, b = last[open_], piece[open_]
        limit = np.full(len(open_), len(self.rank), dtype=np.int64)
        while len(open_):
            over = self.pairs.of(a * len(self.rank) + b)
            no = (over >= 0) & (self.rank[over] < limit)
            good[open_[no]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~no & ((ra >= 0) | (rb >= 0))
            open_, a, b, ra, rb = open_[on], a[on], b[on], ra[on], rb[on]
            undo = ra > rb  # equal merges go from left to right, so the right one is the later
            limit = np.where(undo, ra, rb + 1)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return good

    def _lattice(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, size, piece) arcs of segments that end at ``ends``, in byte order of start."""
        begin = np.concatenate([[0], ends[:-1]])
        room = np.repeat(ends, ends - begin) - np.arange(len(text))
        start, size, piece = self.trie.arcs(text, room)
        # the bytes of a character that begins no arc of its length go one by one
        lead = np.flatnonzero((text & 0xC0) != 0x80)
        length = np.zeros(len(text), dtype=np.int64)
        length[lead] = np.diff(np.append(lead, len(text)))
        bare = length > 0
        bare[start[size == length[start]]] = False
        bare = np.flatnonzero(bare)
        width = length[bare]
        if self.of_byte.min() >= 0:
            each = np.repeat(bare, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            more = each, np.ones(len(each), dtype=np.int64), self.of_byte[text[each]]
        else:
            more = bare, width, np.full(len(bare), self.unknown)
        return tuple(np.concatenate(x) for x in zip((start, size, piece.astype(np.int64)), more))

    def shortest_paths(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all segments in order, number of pieces of each segment)."""
        sizes = np.diff(ends, prepend=0)
        start, size, piece = self._lattice(text, ends)
        seg = np.repeat(np.arange(len(ends)), sizes)[start]
        node = start + seg  # a segment of n bytes has n + 1 nodes
        first = ends - sizes + np.arange(len(ends))
        depth = node - first[seg] + size
        longest = int(sizes.max(initial=0))
        order = np.argsort(depth.astype(np.int16) if longest < 1 << 15 else depth, kind="stable")
        node, size, piece = node[order], size[order], piece[order]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(depth, minlength=longest + 1))])
        last = np.full(len(text) + len(ends), -2, dtype=np.int64)  # -2: no path, -1: the start
        origin = np.zeros(len(last), dtype=np.int64)
        last[first] = -1
        cost = np.full(len(last), np.inf)
        cost[first] = 0.0
        for d in range(1, len(cuts) - 1):
            own = slice(cuts[d], cuts[d + 1])
            from_, p, to = node[own], piece[own], node[own] + size[own]
            if self.model.kind == BPE:
                live = last[from_] >= -1
                from_, p, to = from_[live], p[live], to[live]
                before = last[from_]
                # after a fallback piece as after the start
                zero = self.may_follow(np.where((before >= 0) & self.normal[before] & self.normal[p], before, -1), p)
                last[to[zero]], origin[to[zero]] = p[zero], from_[zero]
            else:
                c = cost[from_] - np.where(self.normal[p], self.scores[p], 0.0)
                by = np.argsort(-c, kind="stable")  # the least cost of a node is written last
                by = by[c[by] < np.inf]
                cost[to[by]], last[to[by]], origin[to[by]] = c[by], p[by], from_[by]
        at = first + sizes
        on = np.zeros(len(last), dtype=bool)
        at = at[sizes > 0]
        while len(at):
            on[at] = True
            at = origin[at]
            at = at[last[at] >= 0]
        count = np.add.reduceat(on, first) if len(first) else np.zeros(0, dtype=np.int64)
        return last[on].astype(np.int32), count.astype(np.int64)

    def segments(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(normalised bytes of all texts, segment starts, first segment of each text and their number)."""
        plain = pc.replace_substring(texts.cast(pa.large_binary()), BLANK.encode(), b" ")
        plain = pc.fill_null(plain, b"")
        offsets = np.frombuffer(plain.buffers()[1], np.int64, len(plain) + 1, plain.offset * 8)
        data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        full = np.diff(offsets) > 0
        if self.model.prefix:
            data = np.insert(data, offsets[:-1][full], 32)
            offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        blank, apart = data == 32, self.apart[data]
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        cut |= apart
        cut[1:] |= apart[:-1]
        cut[offsets[:-1][full]] = True
        starts = np.flatnonzero(cut)
        return data, starts, np.searchsorted(starts, offsets)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """Piece ids (int32) of each text, null for null."""
        data, starts, of_text = self.segments(texts)
        ends = np.append(starts[1:], len(data)).astype(np.int64) if len(starts) else starts
        edges = np.concatenate([starts[:1], ends]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges.tobytes() or bytes(8)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        flat, sizes = self._distinct(coded.dictionary)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        which = coded.indices.to_numpy(zero_copy_only=False)
        ids = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat, pa.int32())).take(coded.indices).flatten()
        total = np.concatenate([[0], np.cumsum(sizes[which])])
        mask = texts.is_null() if texts.null_count else None
        return pa.ListArray.from_arrays(pa.array(total[of_text], pa.int32()), ids, mask=mask)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of distinct segments and their numbers, composed in blocks by length."""
        if not len(words):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(size, kind="stable")
        bytes_upto = np.cumsum(size[order])
        flat, counts = [], np.zeros(len(words), dtype=np.int64)
        at = 0
        while at < len(order):
            on = max(at + 1, int(np.searchsorted(bytes_upto, (bytes_upto[at - 1] if at else 0) + BLOCK_BYTES)))
            own = order[at:on]
            part = words.take(pa.array(own))
            text = np.frombuffer(part.buffers()[2] or b"", np.uint8)[:int(size[own].sum())]
            ids, n = self.shortest_paths(text, np.cumsum(size[own]))
            flat.append(ids)
            counts[own] = n
            at = on
        flat = np.concatenate(flat)
        # back from the order of length
        begin = np.zeros(len(words), dtype=np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        place = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(len(flat))
        return flat[place], counts

    def encode(self, text: str) -> np.ndarray:
        """Piece ids (int32) of one text."""
        return self.encode_all(pa.array([text], pa.string())).flatten().to_numpy()

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids, null for null; bytes that are no UTF-8 become U+FFFD."""
        lists = pc.fill_null(ids, pa.scalar([], ids.type)) if ids.null_count else ids
        flat = self.text_of.take(lists.flatten())
        upto = np.concatenate([[0], np.cumsum(pc.binary_length(flat).to_numpy(zero_copy_only=False))]).astype(np.int64)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        edges = upto[np.concatenate([[0], np.cumsum(sizes)])]
        data = np.frombuffer(flat.cast(pa.large_binary()).buffers()[2] or b"", np.uint8)[:int(upto[-1])]
        if self.model.prefix:
            first = edges[:-1][np.diff(edges) > 0]
            gone = np.zeros(len(data), dtype=bool)
            gone[first] = data[first] == 32
            edges = edges - np.concatenate([[0], np.cumsum(gone)])[edges]
            data = data[~gone]
        raw = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data)])
        try:
            text = raw.cast(pa.string())
        except pa.ArrowInvalid:
            text = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())
        return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), text) if ids.null_count else text

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array([list(ids)], pa.list_(pa.int32())))[0].as_py()


def load(path: str = MODEL_PATH) -> Transducer:
    with open(path, "rb") as f:
        return Transducer(PieceModel(f.read()))


def _split(b: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` by ``sizes``; a larger row stays whole."""
    upto, at = np.cumsum(sizes), 0
    while at < b.num_rows:
        on = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most)))
        yield b.slice(at, on - at)
        at = on


def _sizes(c: pa.Array) -> np.ndarray:
    length = pc.binary_length(c) if pa.types.is_string(c.type) else pc.list_value_length(c)
    return pc.fill_null(length, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _apply(rows: DataFrame, transducer: Transducer, of: str, kind: str, steps: list[tuple[str, str]], call) -> DataFrame:
    """``rows`` with the columns that ``call(transducer, column)`` gives, ``steps`` as (name, type)."""
    names, at = rows.columns, rows.columns.index(of)
    keys, more = [f"c{i}" for i in range(len(names))], [f"m{i}" for i in range(len(steps))]
    shared = rows.sparkSession.sparkContext.broadcast(transducer)  # the model file's pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _split(whole, _sizes(whole.column(at)), BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([*b.columns, *call(shared.value, b.column(at))], names=[*keys, *more])

    plain = rows.toDF(*keys)
    plain = plain.withColumn(f"c{at}", F.col(f"c{at}").cast(kind))
    schema = ", ".join([*(f"{n} {t}" for n, t in plain.dtypes), *(f"{m} {t}" for m, (_, t) in zip(more, steps))])
    return plain.mapInArrow(run, schema).toDF(*names, *(n for n, _ in steps))


def encode(docs: DataFrame, transducer: Transducer, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with all columns and ``ids`` (array<int>), the pieces of the whole text.

    A null text has null ids, an empty one none.  ``ids_col`` comes last, also if the input has a
    column of that name.  An empty table gives no rows; repeated rows are encoded each.  A task holds
    about ``BATCH_BYTES`` of text or one longer text, and the lattice of ``BLOCK_BYTES`` of distinct
    segments or of one longer segment (text without blanks).
    """
    return _apply(docs, transducer, text_col, "string", [(ids_col, "array<int>")], lambda t, c: [t.encode_all(c)])


def decode(rows: DataFrame, transducer: Transducer, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with all columns and the text of ``ids`` (null for null), as the last column.

    The text is the encoded one with U+2581 read as a blank; ids out of range fail.
    """
    return _apply(rows, transducer, ids_col, "array<int>", [(text_col, "string")], lambda t, c: [t.decode_all(c)])


def round_trip(docs: DataFrame, transducer: Transducer, *, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str = "decoded") -> DataFrame:
    """``decode`` after ``encode``, in one pass."""

    def both(t: Transducer, c: pa.Array) -> list[pa.Array]:
        ids = t.encode_all(c)
        return [ids, t.decode_all(ids)]

    return _apply(docs, transducer, text_col, "string", [(ids_col, "array<int>"), (decoded_col, "string")], both)
