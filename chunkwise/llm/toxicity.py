"""Toxicity by gradient-boosted trees over dense features (operator 3).

Two lexicons are learned from labelled rows: whole words, and the first four to
six letters of words (for families of inflected words). A text's features are the densities
and counts of both, of their words after undoing disguises (``1di0t``,
``s-t-u-p-i-d``), how near they stand to a second-person pronoun, and the rates of
capitals, exclamation marks, other marks and disguised words. Boosted trees score
the features and isotonic regression, fitted on rows that the trees did not see,
maps scores to probabilities.

Training takes at most about ``rows_per_class`` labelled rows of each class, drawn
by the hash of the id and weighted back to the classes' shares.

Defined results: whole texts are scored, of any length; a null text counts as
empty, and empty texts get the score of their features (all zero); equal texts
get equal scores; a row labelled twice is toxic if any label says so; null labels
are none; with labels of one class only, or none, every score is that class's
share (0 without labels). Extra columns of the input are never read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.config import materialize

from .boosting import Trees, fit_isotonic, fit_trees
from .common import WordCache, clean_after, resident

STEMS = (4, 5, 6)  # letters
# Second-person pronouns of the languages at hand, and the
# characters that commonly stand in for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself ur u du dich dir dein deine deiner ihr euch euer eure sie ihnen tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os".split()
)
_STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"})

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_REPEAT = re.compile(r"(.)\1{2,}")
_WORDS_AT_ONCE = 200_000
# per-word columns
WORD, STEMMED, DISGUISED, YOU, CAPS, ODD, BANGS, MARKS, LETTERS, UPPER = range(10)


def core(word: str) -> str:
    """The word in lower case without marks at its ends."""
    return _EDGE.sub("", word.lower())


def undisguised(word: str) -> str:
    """The word with stand-ins read as letters, inner marks dropped and long repeats shortened."""
    return _REPEAT.sub(r"\1", _INNER.sub("", word.lower().rstrip(".,;:!?").translate(_STAND_INS)))


@dataclass
class Features:
    """Maps texts to feature rows; ``words`` and ``stems`` are lexicons with weights."""

    words: dict[str, float]
    stems: dict[str, float]
    names: tuple[str, ...] = field(
        default=("word_sum", "word_count", "word_density", "stem_sum", "stem_count", "stem_density", "disguised_count", "disguised_density", "nearness", "caps_rate", "upper_rate", "odd_rate", "bang_rate", "mark_rate", "log_words"),
        init=False,
    )

    def __post_init__(self):
        self._cache = None
        self.key = uuid.uuid4().hex  # workers know it by this

    def __getstate__(self):
        return {**self.__dict__, "_cache": None}

    def _columns(self, words: list[str]) -> list[bytes]:
        out = np.zeros((len(words), 10), dtype=np.float32)
        for row, w in zip(out, words, strict=True):
            c = core(w)
            row[WORD] = self.words.get(c, 0.0)
            row[STEMMED] = max([self.stems.get(c[:n], 0.0) for n in STEMS if len(c) > n], default=0.0)
            row[YOU] = c in SECOND_PERSON
            letters = sum(map(str.isalpha, w))
            row[LETTERS], row[UPPER] = letters, sum(map(str.isupper, w))
            row[CAPS] = letters > 1 and row[UPPER] == letters
            row[BANGS], row[MARKS] = w.count("!"), len(w) - sum(map(str.isalnum, w))
            if letters and letters < len(c):
                row[ODD] = 1
            plain = undisguised(w)
            if plain != c:
                row[DISGUISED] = self.words.get(plain, 0.0)
        return [row.tobytes() for row in out]

    def of(self, text: str) -> list[float]:
        if self._cache is None:
            self._cache = WordCache(self._columns, limit=100_000)
        words = text.split()
        n = len(words)
        if not n:
            return [0.0] * len(self.names)
        sums, counts = np.zeros(10), np.zeros(10)
        hits, yous = [], []
        for k in range(0, n, _WORDS_AT_ONCE):
            rows = np.frombuffer(b"".join(self._cache.values(words[k : k + _WORDS_AT_ONCE])), dtype=np.float32).reshape(-1, 10)
            sums += rows.sum(axis=0, dtype=np.float64)
            counts += (rows != 0).sum(axis=0)
            hits.append(k + np.flatnonzero(rows[:, WORD] + rows[:, STEMMED] + rows[:, DISGUISED]))
            yous.append(k + np.flatnonzero(rows[:, YOU]))
        hit, you = np.concatenate(hits), np.concatenate(yous)
        nearness = 0.0
        if len(hit) and len(you):
            right = np.searchsorted(you, hit)
            gap = np.minimum(np.abs(hit - you[np.maximum(right - 1, 0)]), np.abs(you[np.minimum(right, len(you) - 1)] - hit))
            nearness = float((1 / (1 + gap)).max())
        letters = max(1.0, sums[LETTERS])
        return [
            sums[WORD], counts[WORD], sums[WORD] / n, sums[STEMMED], counts[STEMMED], sums[STEMMED] / n, counts[DISGUISED], sums[DISGUISED] / n,
            nearness, counts[CAPS] / n, sums[UPPER] / letters, counts[ODD] / n, sums[BANGS] / n, sums[MARKS] / n, float(np.log1p(n)),
        ]


@dataclass
class Model:
    features: Features
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    share: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.share)
        return self.calibrated(np.array([self.features.of(t) for t in texts], dtype=np.float64))

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.trees.raw(x), *self.knots), 0.0, 1.0)


def learn_lexicon(sample: DataFrame, words_kept: int = 3000, least_docs: int = 3, least_odds: float = 1.0) -> tuple[dict, dict]:
    """Words and stems that toxic rows of the bounded sample use more than others do, with
    the lower end of their log odds (1.64 standard errors down). Equal texts count once, as
    toxic if any row is; where that leaves one class alone, the lexicons are empty."""
    sample = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return {}, {}
    bare = F.regexp_replace(F.lower("text"), r"(?U)(?<=^|\s)[\W_]+|[\W_]+(?=\s|$)", " ")
    words = sample.select("toxic", F.monotonically_increasing_id().alias("doc"), F.explode(F.array_distinct(F.split(bare, r"\s+"))).alias("word"))
    words = words.where("word <> ''")
    starts = F.filter(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEMS]), lambda s: s.isNotNull())
    stems = words.select("toxic", "doc", F.explode(starts).alias("word")).distinct()

    def odds(rows: DataFrame) -> dict[str, float]:
        counted = rows.groupBy("word").agg(F.sum((F.col("toxic") == 1).cast("long")).alias("hit"), F.sum((F.col("toxic") == 0).cast("long")).alias("miss"))
        cells = [F.col("hit") + 0.5, sizes[1] - F.col("hit") + 0.5, F.col("miss") + 0.5, sizes[0] - F.col("miss") + 0.5]
        error = F.sqrt(1 / cells[0] + 1 / cells[1] + 1 / cells[2] + 1 / cells[3])
        value = F.log(cells[0] * cells[3] / (cells[1] * cells[2])) - 1.64 * error
        kept = counted.where(F.col("hit") >= least_docs).withColumn("odds", value).where(F.col("odds") >= least_odds)
        return {r["word"]: r["odds"] for r in kept.orderBy(F.desc("odds"), "word").limit(words_kept).collect()}

    return odds(words), odds(stems)


def train(docs: DataFrame, labels: DataFrame, learn: Column, rows_per_class: int = 4000) -> Model:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); only rows where ``learn`` holds, a
    condition on doc_id, are read."""
    marks = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    none = Model(Features({}, {}), None, (np.zeros(1), np.zeros(1)), share)
    if len(totals) < 2:
        return none
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    rate = F.when(F.col("toxic") == 1, F.lit(rows_per_class / totals[1])).otherwise(F.lit(rows_per_class / totals[0]))
    picked = F.broadcast(marks.where(draw < rate))  # about 2 * rows_per_class ids
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id")
    sample = materialize(sample, "toxicity_sample")
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("text")), F.lit(3))  # equal texts stay together
    parts = {r["toxic"]: r["n"] for r in sample.where(fold != 0).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(parts) < 2:
        return none
    # with rows enough, lexicons, trees and calibration each have a third of their own
    apart = min(parts.values()) >= 300
    features = Features(*learn_lexicon(sample.where(fold == 1 if apart else fold != 0)))

    @F.arrow_udf("array<double>")
    def rows_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = resident(("toxicity", features.key), lambda: features)
        for batch in texts:
            yield pa.array([own.of(t) for t in batch.to_pylist()], pa.list_(pa.float64()))

    got = sample.select("doc_id", "toxic", fold.alias("fold"), rows_of("text").alias("x")).collect()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    x, y, f = np.array([r["x"] for r in got]), np.array([float(r["toxic"]) for r in got]), np.array([r["fold"] for r in got])
    weight = np.where(y == 1, totals[1] / max(1, (y == 1).sum()), totals[0] / max(1, (y == 0).sum()))
    weight /= weight.mean()
    held = f == 0
    if len(set(y[held])) < 2:
        held = np.ones(len(y), dtype=bool)
    grown = f == 2 if apart else f != 0
    if len(set(y[grown])) < 2:
        grown = np.ones(len(y), dtype=bool)
    trees = fit_trees(x[grown], y[grown], weight[grown])
    raw = trees.raw(x)
    return Model(features, trees, fit_isotonic(raw[held], y[held], weight[held]), share)


def toxic_score(text: Column, model: Model) -> Column:
    """The calibrated probability of the whole text, as a column."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model.features = resident(("toxicity", model.features.key), lambda: model.features)
        for batch in clean_after(batches):
            parts = [model.scores(batch.slice(k, 256).to_pylist()) for k in range(0, len(batch), 256)]  # few texts at a time
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, score, predicted."""
    rows = docs.select(F.col(id_col).alias("doc_id"), toxic_score(F.col(text_col), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
