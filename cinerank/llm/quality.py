"""Quality classifier from weak labels.

1. *Labellers* vote on every whole text: good (+1), bad (-1) or abstain (0).  There are two
   overlapping families: style labellers (shouting, symbols, symbols for words, stuttering, poor vocabulary,
   unfinished lines, few short words) for junk, and stem labellers (word stems that are nearly always
   toxic in a bounded sample of labelled rows and in each of its two halves) for toxic texts.
2. The counts of vote patterns over all documents (at most 3^labellers rows) go through
   expectation-maximisation for each family: it estimates the class share and every labeller's
   accuracy without any label, and so the posterior of each pattern.
3. The posteriors label a bounded sample of texts (``fit_rows``), on which a hashed linear scorer
   (logistic regression on word stems and votes) is trained.
4. The scorer rates every text; those at ``reject_at`` or above are rejected.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.text import as_bytes

SLOTS = 1 << 16
STEM = 4  # letters of a scorer's stem
LIST_STEM = 8  # of a stem in the toxic labellers' lists
LABEL_ROWS = 16_000
FIT_ROWS = 12_000
REJECT_AT = 0.5
MIN_STEM_ROWS, MIN_HALF_ROWS = 6, 4
MIN_STEM_SHARE = 0.98
SYMBOLS = b"#$%&*|!@^~<>{}[]=_+\\/"
VARIETY_WORDS = 1000  # the share of distinct words is taken in windows of so many words

STYLE = ("shouting", "symbols", "bare_symbols", "stutter", "variety", "endings", "short_words")
TOXIC = ("stems", "stems_a", "stems_b")
LABELLERS = STYLE + TOXIC

_symbol = np.zeros(256, dtype=np.int64)
_symbol[list(SYMBOLS)] = 1


def _vote(bad: bool, good: bool) -> int:
    return -1 if bad else 1 if good else 0


def _variety(words: list[str]) -> float:
    """Share of distinct words, averaged over the windows of the whole text by their words."""
    return sum(len(set(words[a:a + VARIETY_WORDS])) for a in range(0, len(words), VARIETY_WORDS)) / len(words)


def style_votes(raw: bytes, words: list[str]) -> list[int]:
    """Votes of the style labellers (in the order of ``STYLE``)."""
    n = len(words)
    if not n:
        return [0, 0, 0, 0, 0, -1, 0]  # nothing to read
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    upper, letters = int(count[65:91].sum()), int(count[65:91].sum() + count[97:123].sum())
    shout = upper / max(1, letters)
    symbol = int((count * _symbol).sum()) / len(raw)
    again = sum(map(operator.eq, words, words[1:])) / n
    variety = _variety(words)
    lines = [x.rstrip() for x in raw.split(b"\n")]
    lines = [x for x in lines if x]
    ended = sum(x[-1:] in b".!?" for x in lines) / max(1, len(lines))
    bare = sum(len(w) < 4 and not any(map(str.isalnum, w)) for w in words) / n
    short = sum(len(w) <= 3 for w in words) / n
    return [
        0 if letters < 10 else _vote(shout > 0.5, shout < 0.3),
        _vote(symbol > 0.04, symbol < 0.02),
        _vote(bare > 0.1, bare < 0.03),
        0 if n < 8 else _vote(again > 0.2, again < 0.05),
        0 if n < 40 else _vote(variety < 0.35, variety > 0.45),
        _vote(ended < 0.3, ended > 0.7),
        0 if n < 20 else _vote(short < 0.12, short > 0.18),
    ]


def stems(words: list[str], letters: int = STEM) -> set[str]:
    return {w[:letters] for w in words}


@dataclass
class Lexicons:
    """The stems of the toxic labellers: of the whole sample and of its halves."""

    lists: tuple[frozenset, ...] = (frozenset(), frozenset(), frozenset())

    def votes(self, words: list[str]) -> list[int]:
        """-1 for a hit; a text of some length without one counts as good."""
        clear, own = 1 if len(words) >= 8 else 0, stems(words, LIST_STEM)
        return [clear if own.isdisjoint(x) else -1 for x in self.lists]


@dataclass
class LabelModel:
    """Class share and accuracies of one family, estimated by expectation-maximisation.

    An abstention is no evidence: only the votes cast are modelled.
    """

    share: float = 0.1
    bad: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))  # P(vote bad | class, votes); class bad first

    @classmethod
    def fit(cls, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
        """patterns: distinct vote rows; counts: documents of each."""
        start = np.tile(np.array([[0.5, 0.02]]), (patterns.shape[1], 1))
        model = cls(0.1, start)
        cast, is_bad = patterns != 0, patterns == -1
        for _ in range(rounds):
            mass = model.posterior(patterns) * counts
            each = np.stack([mass, counts - mass], 1)
            hits, votes = is_bad.T.astype(float) @ each, cast.T.astype(float) @ each
            rate = (hits + 10 * start) / (votes + 10)  # a weak prior: labellers are better than chance
            model = cls(float((mass.sum() + 1) / (counts.sum() + 10)), np.clip(rate, 1e-6, 1 - 1e-6))
        return model

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of the bad class for each vote row."""
        is_bad, is_good = (patterns == -1).astype(float), (patterns == 1).astype(float)
        log = is_bad @ np.log(self.bad) + is_good @ np.log1p(-self.bad) + np.log([self.share, 1 - self.share])
        return 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -500, 500)))


class Scorer:
    """Logistic regression on hashed, binary features (a sorted slot list per text)."""

    def __init__(self) -> None:
        self.weights = np.zeros(SLOTS + 3 * len(LABELLERS) + 1)
        self.trained = False

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(rows)), sizes)
        return np.bincount(of, self.weights[flat], len(rows)) + self.weights[-1]

    def probability(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -30, 30)))

    def fit(self, rows: list[np.ndarray], target: np.ndarray, epochs: int = 30, batch: int = 256, rate: float = 0.1,
            decay: float = 2e-4) -> Scorer:
        rng = np.random.default_rng(11)
        self.trained = bool((target >= 0.5).any() and (target < 0.5).any())  # one class alone teaches nothing
        grown = np.full(len(self.weights), 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                part = [rows[i] for i in own]
                off = self.probability(part) - target[own]
                sizes = np.array([len(r) for r in part])
                grad = np.bincount(np.concatenate(part), np.repeat(off, sizes), len(self.weights)) / len(own)
                grad[-1] = off.mean()
                grad += decay * self.weights
                grown += grad * grad
                self.weights -= rate * grad / np.sqrt(grown)
        return self


_slot: dict[str, int] = {}


def _slots(own: set[str], votes: list[int]) -> np.ndarray:
    """Feature slots of a text: its stems and its votes."""
    if len(_slot) > 500_000:
        _slot.clear()
    out = []
    for s in own:
        at = _slot.get(s)
        if at is None:
            at = _slot[s] = zlib.crc32(s.encode("utf-8", "ignore")) % SLOTS
        out.append(at)
    out += [SLOTS + 3 * k + v + 1 for k, v in enumerate(votes)]
    return np.unique(np.array(out, dtype=np.int64))


def _read(raw: bytes | None) -> tuple[bytes, list[str]]:
    raw = raw or b""
    return raw, raw.decode("utf-8", "replace").lower().split()


def _look(raw: bytes | None, lexicons: Lexicons) -> tuple[list[int], set[str]]:
    raw, words = _read(raw)
    return style_votes(raw, words) + lexicons.votes(words), stems(words)


def _each(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            b = whole.slice(at, 512)
            yield b, as_bytes(b.column(column))


@dataclass
class QualityModel:
    lexicons: Lexicons
    junk: LabelModel
    toxic: LabelModel
    scorer: Scorer

    def posteriors(self, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.junk.posterior(votes[:, :len(STYLE)]), self.toxic.posterior(votes[:, len(STYLE):])

    def scores(self, looks: list[tuple[list[int], set[str]]], junk: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """The scorer's probabilities; the posteriors' where no sample could train it."""
        if not self.scorer.trained:
            return 1 - (1 - junk) * (1 - toxic)
        return self.scorer.probability([_slots(s, v) for v, s in looks])


def _share(h: F.Column, rows: int, total: int) -> F.Column:
    """A condition that holds for about ``rows`` of ``total`` hashes."""
    share = min(1.0, rows / max(1, total))
    return F.pmod(h, F.lit(1_000_003)) < int(share * 1_000_003) + 1


def sample_texts(rows: DataFrame, at_most: int, total: int, salt: int) -> DataFrame:
    """``text`` of at most ``at_most`` of the ``total`` rows (id, text), by the hash of id and text.

    Rows that repeat id and text are one, so neither null ids nor one shared by many rows pass the limit.
    """
    keyed = rows.withColumn("h", F.xxhash64("id", "text", F.lit(salt)))
    return keyed.filter(_share(F.col("h"), at_most, total)).groupBy("h").agg(F.first("text").alias("text")) \
        .orderBy("h").limit(at_most).select("text")


def induce_lexicons(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_rows: int = LABEL_ROWS) -> Lexicons:
    """Stems that are nearly always toxic in a bounded sample of labelled rows, and in each half of it.

    Ids with several labels count by the larger; all rows under a labelled id count.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter("__id is not null and toxic is not null").groupBy("__id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    some = known.filter(_share(F.xxhash64("__id", F.lit(1)), label_rows, total)).orderBy(F.xxhash64("__id", F.lit(1))) \
        .limit(label_rows).withColumn("half", F.pmod(F.xxhash64("__id"), F.lit(2)))
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text"))
    own = texts.join(F.broadcast(some), "__id").select("text", "toxic", "half")  # label_rows rows of 16 bytes

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw in _each(batches, 0):
            found = [sorted(stems(_read(t)[1], LIST_STEM)) for t in raw]
            sizes = [len(x) for x in found]
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for x in found for s in x], pa.string()), b.column(1).take(at), b.column(2).take(at)],
                names=["stem", "toxic", "half"])

    half = lambda h, c: F.sum(F.when(F.col("half") == h, c).otherwise(F.lit(0)))
    rated = own.mapInArrow(words, "stem string, toxic int, half long").groupBy("stem").agg(
        F.sum("toxic").alias("hit"), F.count(F.lit(1)).alias("n"), half(0, F.col("toxic")).alias("hit0"),
        half(0, F.lit(1)).alias("n0"), half(1, F.col("toxic")).alias("hit1"), half(1, F.lit(1)).alias("n1"))
    toxic = [(F.col(h) >= least) & (F.col(h) >= MIN_STEM_SHARE * F.col(n))
             for h, n, least in (("hit", "n", MIN_STEM_ROWS), ("hit0", "n0", MIN_HALF_ROWS), ("hit1", "n1", MIN_HALF_ROWS))]
    picked = rated.select("stem", F.array(*toxic).alias("lists")).filter(F.array_contains("lists", True)) \
        .collect()  # stems frequent among label_rows texts
    return Lexicons(tuple(frozenset(r.stem for r in picked if r.lists[k]) for k in range(3)))


def train(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text",
          label_rows: int = LABEL_ROWS, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Fits label models on the votes of all rows of ``docs`` and the scorer on a bounded sample."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    lexicons = Lexicons() if labels is None else induce_lexicons(
        docs, labels, id_col=id_col, text_col=text_col, label_rows=label_rows)
    shared = spark.sparkContext.broadcast(lexicons)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for _, raw in _each(batches, 0):
            for t in raw:
                key = tuple(_look(t, shared.value)[0])
                seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(k) for k in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())],
            names=["votes", "n"])

    found = rows.select("text").mapInArrow(count, "votes array<int>, n long").groupBy("votes") \
        .agg(F.sum("n").alias("n")).collect()  # one row per vote pattern
    patterns = np.array([r.votes for r in found], dtype=np.int64).reshape(-1, len(LABELLERS))
    counts = np.array([r.n for r in found], dtype=np.float64)
    model = QualityModel(lexicons, LabelModel.fit(patterns[:, :len(STYLE)], counts),
                         LabelModel.fit(patterns[:, len(STYLE):], counts), Scorer())

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in _each(batches, 0):
            looks = [_look(t, shared.value) for t in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, _ in looks], pa.list_(pa.int32())),
                 pa.array([_slots(s, v) for v, s in looks], pa.list_(pa.int32()))],
                names=["votes", "slots"])

    sample = sample_texts(rows, fit_rows, int(counts.sum()), 2) \
        .mapInArrow(features, "votes array<int>, slots array<int>").toPandas()  # at most fit_rows rows
    if len(sample):
        junk, toxic = model.posteriors(np.stack(sample["votes"].to_numpy()).astype(np.int64))
        target = 1 - (1 - junk) * (1 - toxic)
        model.scorer.fit([np.asarray(x, dtype=np.int64) for x in sample["slots"]], target)
    return model


def classify(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text",
             reject_at: float = REJECT_AT) -> DataFrame:
    """doc_id, votes, p_junk, p_toxic, score, kept per row.

    ``p_junk`` and ``p_toxic`` are the weak-label posteriors, ``score`` is the trained scorer's
    probability that the text should go, ``kept`` is score < ``reject_at``.  Null and wordless
    texts have one bad vote (no finished line) and are rated by it alone; repeated rows give one
    row each, null and shared ids change nothing; an empty table gives none; other columns are not read.
    A scorer whose sample is empty or of one class leaves the score to the posteriors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b, raw in _each(batches, 1):
            looks = [_look(t, own.lexicons) for t in raw]
            votes = np.array([v for v, _ in looks], dtype=np.int64).reshape(-1, len(LABELLERS))
            junk, toxic = own.posteriors(votes)
            score = own.scores(looks, junk, toxic)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([v for v, _ in looks], pa.list_(pa.int32())), pa.array(junk), pa.array(toxic),
                 pa.array(score), pa.array(score < reject_at)],
                names=["doc_id", "votes", "p_junk", "p_toxic", "score", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, votes array<int>, p_junk double, p_toxic double, score double, kept boolean")


def keep_good(docs: DataFrame, model: QualityModel, *, text_col: str = "text", reject_at: float = REJECT_AT) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``classify`` keeps; each row is judged by its own text."""
    names, at = docs.columns, docs.columns.index(text_col)
    keys = [f"c{i}" for i in range(len(names))]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b, raw in _each(batches, at):
            looks = [_look(t, own.lexicons) for t in raw]
            votes = np.array([v for v, _ in looks], dtype=np.int64).reshape(-1, len(LABELLERS))
            score = own.scores(looks, *own.posteriors(votes))
            yield b.filter(pa.array(score < reject_at))

    plain = docs.toDF(*keys)
    plain = plain.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    return plain.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in plain.dtypes)).toDF(*names)
