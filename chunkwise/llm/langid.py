"""Language identification by averaged hashed subword embeddings (operator 4).

A text is the average of the embeddings of its words' character n-grams, hashed
into ``2 ** BITS`` buckets; a linear softmax layer over that average gives the
languages' probabilities. Embeddings and layer are trained together by
stochastic gradient descent in numpy. For a trained model the layer can be
applied to the embeddings first, so a text's score is the average of per-word
score vectors, which workers keep for recent words.

Training takes a bounded sample of labelled rows: about ``docs_per_language``
rows of each language, chosen by the hash of the id, and of each the words of at
most ``chars_per_doc`` code points from its middle. A fifth of the sample is not
trained on: it fits the temperature that calibrates the probabilities and the
smallest probability at which at most ``wrong_share`` of the accepted texts are
wrong. Below it the prediction is given, but ``accepted`` is false.

Defined results: a null text, and one without a letter, is ``und`` with score 0;
whole texts are scored, of any length; equal texts get equal results; rows
without a language are never learned from; a tie between languages goes to the
first in order of name; without any labelled row every text is ``und``. Extra
columns of the input are never read.
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

from .common import WordCache, resident
from .ngrams import hashed_ngrams

UNKNOWN = "und"
BITS, SIZES, DIM = 16, (2, 3, 4), 16
_WORD = re.compile(r"[^\W\d_]+")
_WORDS_AT_ONCE = 200_000


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language: embeddings times layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    key: str = field(default_factory=lambda: uuid.uuid4().hex)  # workers know it by this

    def __post_init__(self):
        self._cache = None

    def __getstate__(self):
        return {**self.__dict__, "_cache": None}

    def _word_scores(self, words: list[str]) -> list[bytes]:
        """For each word its summed scores and its number of n-grams."""
        out = np.zeros((len(words), len(self.languages) + 1), dtype=np.float32)
        for owner, bucket in hashed_ngrams(words, SIZES, BITS):
            for k in range(len(self.languages)):
                out[:, k] += np.bincount(owner, self.scores[bucket, k], len(words)).astype(np.float32)
            out[:, -1] += np.bincount(owner, minlength=len(words))
        return [row.tobytes() for row in out]

    def logits(self, text: str) -> np.ndarray | None:
        """None for a text without a letter."""
        if self._cache is None:
            self._cache = WordCache(self._word_scores, limit=200_000)
        words = _WORD.findall(text.lower())
        if not has_letter(words):
            return None
        total = np.zeros(len(self.languages) + 1)
        for k in range(0, len(words), _WORDS_AT_ONCE):
            rows = b"".join(self._cache.values(words[k : k + _WORDS_AT_ONCE]))
            total += np.frombuffer(rows, dtype=np.float32).reshape(-1, len(total)).sum(axis=0, dtype=np.float64)
        return total[:-1] / total[-1] + self.bias

    def predict(self, text: str) -> tuple[str, float, bool]:
        logits = self.logits(text) if self.languages else None
        if logits is None:
            return UNKNOWN, 0.0, False
        p = softmax(logits / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_sgd(docs: list[list[str]], labels: np.ndarray, n_labels: int, epochs: int = 8, rate: float = 1.0, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings times layer, and the layer's bias, from words per document and label numbers."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIM, n_labels)).astype(np.float32)
    bias = np.zeros(n_labels, dtype=np.float32)
    grams = []
    for words in docs:
        counts = np.bincount(np.concatenate([b for _, b in hashed_ngrams(words, SIZES, BITS)]), minlength=1 << BITS)
        used = np.flatnonzero(counts)
        grams.append((used, (counts[used] / counts.sum()).astype(np.float32)))
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for k in range(0, len(order), 16):
            batch = order[k : k + 16]
            step = rate * (1 - done / steps)
            done += len(batch)
            hidden = np.stack([grams[i][1] @ embed[grams[i][0]] for i in batch])
            error = softmax(hidden @ layer + bias)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error /= len(batch)
            back = error @ layer.T
            layer -= step * hidden.T @ error
            bias -= step * 0.1 * error.sum(axis=0)
            for i, g in zip(batch, back, strict=True):
                used, share = grams[i]
                # scaled by the shares, so that a step moves the text's average by ``step * g``
                embed[used] -= step * np.outer(share / (share @ share), g)
    return embed @ layer, bias


def fit(texts: list[str], langs: list[str], wrong_share: float = 0.01, chars_per_doc: int = 2000) -> Model:
    """Train on four fifths of the rows, calibrate on the rest."""
    rows = []
    for text, lang in zip(texts, langs, strict=True):
        start = max(0, (len(text) - chars_per_doc) // 2)
        words = _WORD.findall(text[start : start + chars_per_doc].lower())
        if has_letter(words):
            rows.append((text, words, lang))
    languages = sorted({lang for _, _, lang in rows})
    if not languages:
        return Model([], np.zeros((1, 0)), np.zeros(0))
    labels = np.array([languages.index(lang) for _, _, lang in rows])
    held = np.arange(len(rows)) % 5 == 4
    if held.sum() < 2 * len(languages):
        held[:] = False
    train = np.flatnonzero(~held)
    scores, bias = fit_sgd([rows[i][1] for i in train], labels[train], len(languages))
    model = Model(languages, scores.astype(np.float32), bias.astype(np.float64))
    if held.any():
        checked = np.flatnonzero(held)
        logits = np.stack([model.logits(rows[i][0]) for i in checked])
        truth = labels[checked]

        def loss(t: float) -> float:
            return float(-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean())

        model.temperature = min(np.geomspace(0.05, 20, 60).tolist(), key=loss)
        p = softmax(logits / model.temperature)
        right, sure = p.argmax(axis=1) == truth, p.max(axis=1)
        order = np.argsort(-sure, kind="stable")
        share = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share <= wrong_share)
        model.threshold = float(sure[order][good[-1]]) if len(good) else 1.0
    return model


def train(docs: DataFrame, learn: Column, docs_per_language: int = 1500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on a sample of the rows where ``learn`` holds that are labelled."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = rows.groupBy("lang").agg((F.lit(float(docs_per_language)) / F.count("*")).alias("share"))
    counts = materialize(counts, "langid_counts")  # its size is known to the join: the texts stay where they are
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    picked = materialize(rows.join(counts, "lang").where(draw < F.col("share")).select("doc_id", "text", "lang"), "langid_sample").collect()
    picked.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"]))
    return fit([r["text"] for r in picked], [r["lang"] for r in picked])


def language_of(text: Column, model: Model) -> Column:
    """struct(lang_pred, score, accepted) of whole texts."""

    @F.arrow_udf("struct<lang_pred:string,score:double,accepted:boolean>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = resident(("langid", model.key), lambda: model)
        for batch in batches:
            rows = [own.predict(value.as_py() or "") for value in batch]
            names, scores, accepted = zip(*rows, strict=True) if rows else ((), (), ())
            arrays = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.StructArray.from_arrays(arrays, ["lang_pred", "score", "accepted"])

    return predict(F.coalesce(text, F.lit("")))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, lang_pred, score, accepted."""
    rows = docs.select(F.col(id_col).alias("doc_id"), language_of(F.col(text_col), model).alias("p"))
    return rows.select("doc_id", "p.*")
