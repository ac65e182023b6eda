"""Vectorised word hashing over whole texts, used inside Spark tasks.

Words are found and hashed with numpy over the UTF-8 bytes of many texts at once; no Python
object is made per word.  A word's hash is a polynomial over random 64-bit byte values,
mixed; two distinct words of a corpus with V distinct words collide with probability of
about V^2 / 2^65 (1e-6 for ten million words).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; longer texts are cut between words.
PIECE = 1 << 20

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20240229))
_VALUE = _rng.integers(1, (1 << 63) - 1, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z hash as a-z

_byte = np.arange(256)
#: Which bytes belong to words: "space" is [^\x20\x09-\x0D]+, "alnum" is
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
IS_WORD = {
    "space": ~((_byte == 32) | ((_byte >= 9) & (_byte <= 13))),
    "alnum": (_byte >= 128) | ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90))
    | ((_byte >= 97) & (_byte <= 122)),
}
_power: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    got = _power.get(base)
    if got is None or len(got) < n:
        size = max(n, PIECE + 2)
        full = np.full(size, base, dtype=np.uint64)
        full[0] = 1
        got = np.multiply.accumulate(full)
        if size <= 4 * PIECE:
            _power[base] = got
    return got[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _piece(buf: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of a byte buffer."""
    flag = word[buf].view(np.int8)
    edge = np.flatnonzero(np.diff(flag, prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[buf] * _powers(_P, len(buf)), out=total[1:])
    h = (total[ends] - total[starts]) * _powers(_P_INV, len(buf) + 1)[starts]
    return mix(h), starts


def _cut(text: bytes, word: np.ndarray) -> Iterator[bytes]:
    """A long text in pieces that end between words (one word longer than a piece stays whole)."""
    at = 0
    while at < len(text):
        size = PIECE
        while at + size < len(text):
            gaps = np.flatnonzero(~word[np.frombuffer(text, np.uint8, size, at)])
            if len(gaps):
                size = int(gaps[-1]) + 1
                break
            size *= 2
        yield text[at:at + size]
        at += size


def hash_words(texts: Sequence[bytes | None], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint64) of all words of the texts in order, and the number of words of each text."""
    word = IS_WORD[kind]
    counts = np.zeros(len(texts), dtype=np.int64)
    hashes: list[np.ndarray] = []
    group: list[bytes] = []
    first = size = 0

    def flush() -> None:
        nonlocal group, size
        if not group:
            return
        h, starts = _piece(np.frombuffer(b" ".join(group), dtype=np.uint8), word)
        ends = np.cumsum([len(t) + 1 for t in group])
        upto = np.searchsorted(starts, ends)
        counts[first:first + len(group)] = np.diff(upto, prepend=0)
        hashes.append(h)
        group, size = [], 0

    for i, t in enumerate(texts):
        t = t or b""
        if len(t) > PIECE:
            flush()
            for piece in _cut(t, word):
                h, _ = _piece(np.frombuffer(piece, dtype=np.uint8), word)
                counts[i] += len(h)
                hashes.append(h)
            first = i + 1
            continue
        if size + len(t) + 1 > PIECE:
            flush()
        if not group:
            first = i
        group.append(t)
        size += len(t) + 1
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def phrase(words: str) -> np.ndarray:
    """Word hashes of a phrase ("alnum" words)."""
    return hash_words([words.encode()], "alnum")[0]


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending uint64 keys as byte planes of their differences (the high planes compress away)."""
    d = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)
