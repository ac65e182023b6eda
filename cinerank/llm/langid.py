"""Language identification by nearest centroid.

Texts become L2-normalised TF-IDF vectors of hashed byte n-grams (lower-cased, digits and ASCII
punctuation as blanks); several centroids per language come from spherical k-means; a text takes
the language of the centroid with the largest cosine and is *rejected* when it is farther from it
than nearly all of that centroid's own training texts.

* document frequencies: counted over all training rows in one pass (a fixed-size vector per task);
* centroids: k-means per language on a bounded sample of its training rows (about
  ``sample_rows`` per language, by id hash; equal in expectation at every table size);
* prediction: one matrix product per batch of whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.llm.text import as_bytes

DIM = 4096
GRAMS = (2, 3)
CLUSTERS = 4
SAMPLE_ROWS = 1500
REJECT_QUANTILE = 0.002
MAX_SHARED_LANGS = 100_000
GROUP = 256
UND = "und"

_clean = np.arange(256, dtype=np.uint8)
_clean[[b for b in range(128) if not chr(b).isalpha()]] = 32
_letter = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (bool(_letter.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "ignore")))


def features(texts: list[bytes | None]) -> np.ndarray:
    """n x DIM float32: log(1 + count) of the hashed n-grams of each (lower-cased) text."""
    out = np.zeros((len(texts), DIM), dtype=np.float32)
    piece = 1 << 20

    def add(joined: bytes, ends: np.ndarray, first: int, n: int) -> None:
        b = _clean[np.frombuffer(joined, dtype=np.uint8)].astype(np.uint32)
        at = np.searchsorted(ends, np.arange(len(b)), "right") if n > 1 else np.zeros(len(b), np.int64)
        for g in GRAMS:
            code = np.zeros(max(0, len(b) - g + 1), dtype=np.uint32)
            for j in range(g):
                code = code * np.uint32(257) + b[j:j + len(code)]
            blank = np.uint32(32 * sum(257 ** j for j in range(g)))
            real = code != blank
            slot = (code * np.uint32(0x9E3779B1) + np.uint32(g * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(20)
            cell = at[:len(code)][real] * DIM + slot[real]
            out[first:first + n] += np.bincount(cell, minlength=n * DIM).reshape(n, DIM)

    first, group, size = 0, [], 0

    def flush() -> None:
        nonlocal group, size, first
        if group:
            ends = np.cumsum([len(t) + 2 for t in group])
            add(b"".join(b" " + t + b" " for t in group), ends, first, len(group))
            first += len(group)
        group, size = [], 0

    for t in texts:
        t = t or b""
        if len(t) > piece:
            flush()
            for a in range(0, len(t), piece):  # pieces overlap, so that no n-gram is lost
                part = t[max(0, a - max(GRAMS) + 1):a + piece]
                add(b" " + part + b" " if len(t) <= piece else part, np.array([len(part)]), first, 1)
            first += 1
            continue
        group.append(t)
        size += len(t)
        if size > piece:
            flush()
    flush()
    return np.log1p(out)


def normalised(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def _groups(b: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for at in range(0, b.num_rows, GROUP):
        part = b.slice(at, GROUP)
        yield part, as_bytes(pc.utf8_lower(part.column(column)))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIM, dtype=np.int64), 0
    for b in batches:
        for _, texts in _groups(b, 0):
            df += (features(texts) > 0).sum(axis=0)
            n += len(texts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1)), pa.array(np.append(df, n))], names=["slot", "df"])


def _fit(idf: np.ndarray, clusters: int, quantile: float):
    def run(t: pa.Table) -> pa.Table:
        """Centroids of one language's sample (bounded), and each one's rejection cosine."""
        t = t.sort_by("h").combine_chunks()
        texts = as_bytes(pc.utf8_lower(t.column("text")).combine_chunks())
        x = np.concatenate([normalised(features(texts[a:a + GROUP]), idf) for a in range(0, len(texts), GROUP)])
        x = x[(x * x).sum(axis=1) > 0.5]
        lang = t.column("lang")[0].as_py()
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.binary()),
                             "least": pa.array([], pa.float64())})
        far = [0]  # farthest-first start
        best = x @ x[0]
        for _ in range(min(clusters, len(x)) - 1):
            far.append(int(best.argmin()))
            best = np.maximum(best, x @ x[far[-1]])
        c = x[far]
        for _ in range(12):
            own = (x @ c.T).argmax(axis=1)
            c = np.stack([x[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
            c /= np.maximum(np.sqrt((c * c).sum(axis=1, keepdims=True)), 1e-12)
        near = x @ c.T
        own, near = near.argmax(axis=1), near.max(axis=1)
        least = [float(np.quantile(near[own == k], quantile)) if (own == k).any() else 1.0 for k in range(len(c))]
        return pa.table({"lang": pa.array([lang] * len(c)), "centroid": [v.astype("<f4").tobytes() for v in c],
                         "least": least})

    return run


class LanguageModel:
    """IDF, centroids (k x DIM) with their languages, and each centroid's least cosine."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, least: np.ndarray) -> None:
        self.idf, self.langs, self.centroids, self.least = idf, langs, centroids, least

    def predict(self, lowered: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        known = np.array([has_letter(t) for t in lowered], dtype=bool)
        if not len(self.langs) or not len(lowered):
            return [UND] * len(lowered), np.zeros(len(lowered)), known.copy()
        near = normalised(features(lowered), self.idf) @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(best)), best].astype(np.float64), 0, 1) * known
        lang = [self.langs[k] if ok else UND for k, ok in zip(best.tolist(), known.tolist())]
        return lang, score, ~known | (score < self.least[best])


def train(rows: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          clusters: int = CLUSTERS, sample_rows: int = SAMPLE_ROWS, quantile: float = REJECT_QUANTILE) -> LanguageModel:
    """Learns from the rows of ``rows`` that have a text and a language.

    Centroids are fitted on at most ``sample_rows`` rows of a language, by the hash of id and text; rows
    that repeat both are one there, so null or shared ids never make a larger group.
    """
    rows = rows.select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("h"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .filter("lang is not null and text is not null")
    slots = rows.select("text").mapInArrow(_frequencies, "slot long, df long") \
        .groupBy("slot").agg(F.sum("df").alias("df")).collect()  # DIM + 1 rows
    df = np.zeros(DIM + 1)
    for r in slots:
        df[r.slot] = r.df
    idf = (np.log((df[DIM] + 1) / (df[:DIM] + 1)) + 1).astype(np.float32)
    share = rows.groupBy("lang").count().withColumn("share", F.least(F.lit(1.0), F.lit(float(sample_rows)) / F.col("count")))
    if share.count() <= MAX_SHARED_LANGS:  # one small row per language; beyond, they meet by a shuffle
        share = F.broadcast(share)
    sample = rows.join(share, "lang").filter(F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003) \
        .groupBy("lang", "h").agg(F.first("text").alias("text"))
    by_hash = Window.partitionBy("lang").orderBy("h")
    sample = sample.withColumn("r", F.row_number().over(by_hash)).filter(F.col("r") <= sample_rows)
    fitted = sample.select("lang", "h", "text").groupBy("lang").applyInArrow(
        _fit(idf, clusters, quantile), "lang string, centroid binary, least double")
    found = sorted(fitted.collect(), key=lambda r: (r.lang, r.centroid))  # clusters x languages rows
    centroids = np.stack([np.frombuffer(r.centroid, "<f4") for r in found]) if found else np.zeros((0, DIM), np.float32)
    return LanguageModel(idf, [r.lang for r in found], centroids, np.array([r.least for r in found]))


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected per row.

    ``lang_pred`` is the nearest centroid's language, or ``und`` for a null text or one without a
    letter (also when nothing was learned); ``score`` is the cosine (0 to 1, 0 for ``und``);
    ``rejected`` marks texts beyond the centroid's rejection distance, and all ``und``.  Ties go to
    the first language in order.  Repeated rows give one row each; an empty table none; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # clusters x languages x DIM floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in _groups(b, 1):
                lang, score, rejected = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
