"""Quality classifier: a weak-label model teaches a hashed linear scorer.

Each labeller is a rule of thumb on one measure of a text and votes good, bad or
nothing. The votes overlap and none is trusted beforehand: expectation-maximisation
finds the share of good texts and how often each labeller gives each vote for good and bad
texts (from the number of texts per vote pattern, at most 3 ** labellers of them). Its
posteriors, on a sample of ``SAMPLE`` texts at most, are the targets of a logistic regression
over hashed byte trigrams and binned measures, which scores every text.

A text is kept if its score is at least ``KEEP``. Null and blank texts get score 0. Measures
and votes come from whole texts of all rows; only the regression is fitted on the
sample, the texts with the smallest hashes. Without any text the scorer keeps nothing.
Ties and repeated rows are scored alike; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import words
from .common import parts_of

SAMPLE = 4000
BUCKETS = 4096  # of the scorer's features
KEEP = 0.5
ABSTAIN = 2
_PART = 1 << 19  # bytes of texts taken up at once; the arrays of their trigrams are some fifty times as large

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in that is for it with as on are this be by an at from or not have "
    "der die das und in zu den von mit ist des im für auf ein eine nicht sich auch dem "
    "le la les de des et un une du en que qui dans pour par sur est il elle ne pas "
    "el los las y del que en un una por con para es su se al lo como"
).split()

#: name, measure at or below which the vote is one thing, measure at or above which it is the other, vote of high values
LABELLERS = (
    ("symbols", 0.01, 0.04, 0),
    ("capitals", 0.12, 0.30, 0),
    ("exclamations", 0.004, 0.02, 0),
    ("digits", 0.05, 0.20, 0),
    ("new_pairs", 0.50, 0.80, 1),
    ("same_again", 0.02, 0.10, 0),
    ("top_word", 0.15, 0.25, 0),
    ("stop_words", 0.05, 0.12, 1),
    ("sentence_ends", 0.005, 0.03, 1),
    ("word_length", 9.0, 14.0, 0),
)
MEASURES = [m for m, *_ in LABELLERS]
FEW_WORDS = 20  # shares of fewer words tell little; these labellers then abstain
NEED_WORDS = ("digits", "word_length", "new_pairs", "same_again", "top_word", "stop_words", "sentence_ends")


def _share(data: np.ndarray, offsets: np.ndarray, chosen: bytes | np.ndarray) -> np.ndarray:
    """Number of the chosen byte values per text."""
    table = np.zeros(256, np.int64)
    table[list(chosen)] = 1
    sums = np.concatenate([[0], np.cumsum(table[data])])
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)


def measures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """An array of (texts, measures) and the number of words per text."""
    data, offsets = words.text_bytes(texts)
    size = np.maximum(np.diff(offsets), 1)
    hashes, counts = words.word_hashes(texts)
    number = np.maximum(counts, 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    stops = _stop_hashes()
    found = np.bincount(owner, weights=np.isin(hashes, stops), minlength=len(counts))
    run_owner, run = words.shingle_hashes(texts, 2)
    distinct_owner, _, _ = words.counted(run_owner, run)
    runs = np.bincount(run_owner, minlength=len(counts))
    new = np.where(runs > 0, np.bincount(distinct_owner, minlength=len(counts)) / np.maximum(runs, 1), 1.0)
    again = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=len(counts))
    word_owner, _, times = words.counted(owner, hashes)
    top = np.zeros(len(counts))
    np.maximum.at(top, word_owner, times)
    upper = _share(data, offsets, range(65, 91))
    lower = _share(data, offsets, range(97, 123))
    spaces = _share(data, offsets, b"\t\n\x0b\x0c\r ")
    continued = _share(data, offsets, range(128, 192))
    columns = {
        "symbols": _share(data, offsets, b"*$%&#@^~<>{}[]\\|=+_") / size,
        "capitals": upper / np.maximum(upper + lower, 1),
        "exclamations": _share(data, offsets, b"!") / size,
        "digits": _share(data, offsets, range(48, 58)) / size,
        "new_pairs": new,
        "same_again": again / number,
        "top_word": top / number,
        "stop_words": found / number,
        "sentence_ends": _share(data, offsets, b".?") / number,
        "word_length": (np.diff(offsets) - spaces - continued) / number,
    }
    return np.column_stack([columns[m] for m in MEASURES]), counts


def _stop_hashes() -> np.ndarray:
    forms = [f for w in STOP_WORDS for f in (w, w.capitalize(), w + ",", w + ".")]
    return np.unique(words.word_hashes(pa.array(forms))[0])


def votes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(texts, labellers) of 0, 1 or ``ABSTAIN``; texts without words get no votes."""
    out = np.full(values.shape, ABSTAIN, np.int64)
    for i, (name, low, high, of_high) in enumerate(LABELLERS):
        enough = counts >= (FEW_WORDS if name in NEED_WORDS else 1)
        out[enough & (values[:, i] <= low), i] = 1 - of_high
        out[enough & (values[:, i] >= high), i] = of_high
    return out


def _code(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


@dataclass
class VoteModel:
    """Share of good texts, and P(vote | class) as (labeller, class, vote)."""

    good: float
    table: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """P(good | votes); an abstention tells nothing, so that only opinions count."""
        log = np.log(np.maximum([1 - self.good, self.good], 1e-12)) * np.ones((len(v), 1))
        for j in range(v.shape[1]):
            said = v[:, j] != ABSTAIN
            log[said] += np.log(self.table[j][:, v[said, j]].T)
        log -= log.max(1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(1)


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, tolerance: float = 1e-9) -> VoteModel:
    """Expectation-maximisation from distinct vote patterns and how many texts have each; starts from the majority."""
    good_votes, bad_votes = (patterns == 1).sum(1), (patterns == 0).sum(1)
    p = (good_votes + 1) / (good_votes + bad_votes + 2)
    model = VoteModel(0.5, np.full((patterns.shape[1], 2, 2), 0.5))
    for _ in range(rounds):
        table = np.empty_like(model.table)
        for j in range(patterns.shape[1]):
            for y, weight in enumerate((counts * (1 - p), counts * p)):
                for vote in (0, 1):
                    # a little prior weight on the right vote keeps the classes from changing places
                    table[j, y, vote] = weight[patterns[:, j] == vote].sum() + (4.0 if vote == y else 1.0)
        table /= table.sum(2, keepdims=True)
        model = VoteModel(float((counts * p).sum() + 1) / float(counts.sum() + 2), table)
        new = model.posterior(patterns)
        change = np.abs(new - p).max() if len(p) else 0.0
        p = new
        if change < tolerance:
            break
    return model


def features(texts: pa.Array, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and value of every feature: shares of hashed byte trigrams, and the measures in bins."""
    data, offsets = words.text_bytes(texts)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(len(size)), size)
    if len(data) > 2:
        x = data.astype(np.uint32)
        gram = (x[:-2] * np.uint32(961) + x[1:-1] * np.uint32(31) + x[2:]) * np.uint32(2654435761) >> np.uint32(32 - 12)
        same = owner[:-2] == owner[2:]
        grams, gram_owner = gram[same].astype(np.int64) % BUCKETS, owner[:-2][same]
    else:
        grams, gram_owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
    bins = []
    for i, (_, low, high, _) in enumerate(LABELLERS):
        edges = np.array([low / 2, low, (low + high) / 2, high, 2 * high])
        bins.append((np.searchsorted(edges, values[:, i]) + 7 * i + 500 * (counts < FEW_WORDS)) * 2654435761 % BUCKETS)
    texts_at = np.tile(np.arange(len(size)), len(bins))
    return (
        np.concatenate([gram_owner, texts_at]), np.concatenate([grams, *bins]),
        np.concatenate([20.0 / np.maximum(size[gram_owner] - 2, 1), np.ones(len(texts_at))]),
    )


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        owner, bucket, value = features(texts, values, counts)
        z = np.bincount(owner, weights=self.weights[bucket] * value, minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_scorer(begins: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft targets by full gradient steps with momentum; text i has the entries ``begins[i]`` up to ``begins[i + 1]``."""
    n = len(target)
    text = np.repeat(np.arange(n, dtype=np.int32), np.diff(begins))
    w, b = np.zeros(BUCKETS), 0.0
    step_w, step_b = np.zeros_like(w), 0.0
    for _ in range(rounds if n else 0):
        z = np.bincount(text, weights=w[bucket] * value, minlength=n) + b
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - target
        step_w = 0.9 * step_w - rate * (np.bincount(bucket, weights=error[text] * value, minlength=BUCKETS) / n + decay * w)
        step_b = 0.9 * step_b - rate * error.mean()
        w, b = w + step_w, b + step_b
    return Scorer(w, b)


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> tuple[VoteModel, Scorer]:
    """Both models from all rows of ``docs``."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, _PART):
            values, counts = measures(part.column(0))
            code, n = np.unique(_code(votes(values, counts))[counts > 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    texts = docs.select(F.col(text_col).alias("text"))
    # at most 3 ** labellers rows
    seen = texts.mapInArrow(vote, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    code = np.array([r["code"] for r in seen], np.int64)
    patterns = code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    number = np.array([r["n"] for r in seen], float)
    model = fit_votes(patterns.reshape(len(code), len(LABELLERS)), number)
    total = int(number.sum())

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, _PART):
            values, counts = measures(part.column(0))
            owner, bucket, value = features(part.column(0), values, counts)
            entry, at = np.unique(owner * BUCKETS + bucket, return_inverse=True)
            share = np.bincount(at, weights=value).astype(np.float32)
            begins = pa.array(np.searchsorted(entry, np.arange(part.num_rows + 1) * BUCKETS), pa.int32())
            target = model.posterior(votes(values, counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(target), pa.ListArray.from_arrays(begins, pa.array(entry % BUCKETS, pa.int16())), pa.ListArray.from_arrays(begins, pa.array(share, pa.float32()))],
                ["target", "bucket", "share"],
            )

    place = F.abs(F.xxhash64("text") % 1_000_000_007)
    share = min(1.0, 1.5 * sample / max(total, 1))
    some = texts.where(F.length(F.trim("text")) > 0).withColumn("place", place).where(F.col("place") < share * 1_000_000_007)
    # the entries that are not zero of `sample` texts, BUCKETS a text at most
    rows = some.orderBy("place", "text").limit(sample).select("text").mapInArrow(featured, "target double, bucket array<smallint>, share array<float>").toArrow()
    bucket = rows["bucket"].combine_chunks()
    begins = np.concatenate([[0], np.cumsum(np.array([len(x) for x in bucket], np.int64))]).astype(np.int64)
    share = rows["share"].combine_chunks().flatten().to_numpy()
    return model, fit_scorer(begins, bucket.flatten().to_numpy().astype(np.int32), share, rows["target"].to_numpy())


def classify(docs: DataFrame, text_col: str = "text", models: tuple[VoteModel, Scorer] | None = None, keep: float = KEEP) -> DataFrame:
    """``docs`` with ``posterior, score, keep``: the weak-label model's belief, the scorer's, and whether to keep the text."""
    model, scorer = models or fit(docs, text_col)
    names = [c for c in docs.columns if c not in ("posterior", "score", "keep")]
    schema = T.StructType([docs.schema[c] for c in names]).add("posterior", "double").add("score", "double").add("keep", "boolean")
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, _PART):
            texts = part.column(at)
            values, counts = measures(texts)
            score = np.where(counts > 0, scorer.score(texts, values, counts), 0.0)
            belief = np.where(counts > 0, model.posterior(votes(values, counts)), 0.0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(belief), pa.array(score), pa.array(score >= keep)], [*names, "posterior", "score", "keep"])

    return docs.select(*names).mapInArrow(run, schema)
