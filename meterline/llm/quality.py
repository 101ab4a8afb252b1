"""Text quality from weak labels: overlapping heuristics, a label model, and a hashed linear scorer.

1. Eight heuristic labellers vote good, bad or nothing on each document.
2. Vote patterns are counted over all documents; there are at most 3 ** 8 of them. Expectation-
   maximisation over these counts estimates how often each labeller is right for good and for bad
   documents (Dawid and Skene, 1979), and with it the probability that a pattern means good.
3. A sample of about ``TRAINING_ROWS`` documents, drawn by a hash of their text, takes these
   probabilities as labels. Logistic regression on hashed words and word shapes is fitted to it in one
   task, whose memory the sample size bounds.
4. The scorer reads every document whole; those with a probability of good below ``REJECTED`` go.
"""

from __future__ import annotations

import re
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from meterline.llm.batches import bound_batches, worker_memory
from meterline.sources.scratch import stored

GOOD, BAD, NONE = 1, -1, 0
TRAINING_ROWS = 20_000
BUCKETS = 1 << 18
EPOCHS = 6
RATE = 0.5
REJECTED = 0.5
ROUNDS = 200
FAULTY_AT_FIRST = np.array([0.05, 0.5, 0.95])
REMEMBERED = 100_000

# --- fixed values: frequent function words of the languages served -----------------------------
FUNCTION_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they"
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er so dass"
    " de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont"
    " el los y del las por con una su para es al lo como más o pero sus le ha me si sin sobre este ya".split()
)
# --- end of fixed values ------------------------------------------------------------------------

LETTER = re.compile(r"[^\W\d_]")
SHAPE = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "0"))


def _between(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else NONE


def votes(text: str) -> list[int]:
    """One vote of each labeller. A text without words gets a vote on its length only."""
    tokens = text.split()
    n = len(tokens)
    if n == 0:
        return [BAD, *[NONE] * (len(LABELLERS) - 1)]
    marks = sum(map(text.count, "#$%&*|<>{}[]^~=\\@_")) / len(text)
    same = [a == b for a, b in zip(tokens, tokens[1:])]
    repeated = sum(same) / n
    pairs = len(set(zip(tokens, tokens[1:]))) / max(1, n - 1)
    wordless = sum(not t.isalpha() and not LETTER.search(t) for t in tokens) / n
    ended = sum(t[-1] in ".!?" for t in tokens) / n
    function = sum(t in FUNCTION_WORDS for t in text.lower().split()) / n
    return [
        _between(n < 2, n >= 2),
        _between(marks > 0.06, marks < 0.02),
        _between(n >= 10 and repeated > 0.1, repeated < 0.03 and n >= 10),
        _between(repeated > 0.02 and _longest_run(same) >= 8, n >= 20),
        _between(n >= 20 and pairs < 0.7, n >= 20 and pairs > 0.85),
        _between(n >= 20 and wordless > 0.15, wordless < 0.05 and n >= 10),
        _between(n >= 40 and not 0.01 <= ended <= 0.5, n >= 10 and 0.02 <= ended <= 0.35),
        _between(n >= 30 and function < 0.03, function > 0.12),
    ]


LABELLERS = ("length", "marks", "stutter", "runs", "word pairs", "wordless", "sentences", "function words")


def _longest_run(same: list[bool]) -> int:
    """Of equal words that follow each other."""
    return 1 + max((sum(1 for _ in run) for equal, run in groupby(same) if equal), default=0)


def _pattern(vote: list[int]) -> int:
    return int(sum((v + 1) * 3**k for k, v in enumerate(vote)))


@F.pandas_udf(IntegerType())
def vote_pattern(texts: pd.Series) -> pd.Series:
    """The votes as digits of base three. Null counts as empty."""
    return pd.Series([_pattern(votes(text or "")) for text in texts], dtype=np.int32)


def estimate(patterns: np.ndarray, counts: np.ndarray, labellers: int = len(LABELLERS)):
    """Expectation-maximisation over counted patterns.

    Returns the probability of good for each pattern, that of good overall, and for each labeller how
    often it is right about bad and about good documents, where it votes. A missing vote says nothing;
    votes are taken to be independent given the class. Labellers look for different faults, so a bad
    document need not displease most of them: at the start it is bad the surer, the more faults it has.
    """
    vote = patterns[:, None] // 3 ** np.arange(labellers) % 3 - 1
    says = np.stack([vote == BAD, vote == GOOD], axis=2).astype(float)  # pattern, labeller, vote
    good = 1 - FAULTY_AT_FIRST[np.minimum((vote == BAD).sum(axis=1), len(FAULTY_AT_FIRST) - 1)]
    for _ in range(ROUNDS):
        weight = np.stack([counts * (1 - good), counts * good])  # class, pattern
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        law = np.einsum("cp,plv->clv", weight, says) + 1.0
        law /= law.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,clv->pc", says, np.log(law)) + np.log(prior)
        before, good = good, 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        if np.abs(good - before).max() < 1e-6:
            break
    return good, float(prior[1]), np.stack([law[0, :, 0], law[1, :, 1]], axis=1)


def _shape(token: str) -> str:
    for pattern, mark in SHAPE:
        token = pattern.sub(mark, token)
    return token


def _bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) % BUCKETS


def features(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features with shares of the tokens: the word, its shape, and whether it repeats the last."""
    known = worker_memory().setdefault("quality features", {})
    if len(known) > REMEMBERED:
        known.clear()
    found: list[int] = []
    for token in tokens:
        pair = known.get(token)
        if pair is None:
            pair = known[token] = (_bucket("word " + token.lower()), _bucket("shape " + _shape(token)))
        found += pair
    stutter = sum(a == b for a, b in zip(tokens, tokens[1:]))
    at, count = np.unique(np.array([*found, *[_bucket("stutter")] * stutter, *[_bucket("all")] * len(tokens)]), return_counts=True)
    return at, np.sqrt(count / max(1, len(tokens)))


def fit(texts: list[str], target: np.ndarray, seed: int = 7) -> np.ndarray:
    """Logistic regression by adaptive gradient steps; the last weight is the intercept."""
    rows = [features(text.split()) if text.strip() else (np.zeros(0, int), np.zeros(0)) for text in texts]
    weights, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for n in rng.permutation(len(rows)):
            at, value = np.append(rows[n][0], BUCKETS).astype(int), np.append(rows[n][1], 1.0)
            error = 1 / (1 + np.exp(-np.clip(weights[at] @ value, -30, 30))) - target[n]
            gradient = error * value
            squares[at] += gradient**2
            weights[at] -= RATE * gradient / np.sqrt(squares[at])
    return weights


def train(df: DataFrame, rows: int = TRAINING_ROWS) -> np.ndarray:
    """Weights of the scorer for the documents of ``df``; an empty table gives zeros."""
    voted = stored(df.select(F.xxhash64("text").alias("key"), vote_pattern("text").alias("pattern")), "votes")
    counted = voted.groupBy("pattern").count().orderBy("pattern").collect()
    if not counted:
        return np.zeros(BUCKETS + 1)
    patterns = np.array([row.pattern for row in counted])
    counts = np.array([row["count"] for row in counted], dtype=float)
    good, _, _ = estimate(patterns, counts)
    probability = dict(zip(patterns.tolist(), good.tolist()))

    # equal texts share a hash and are drawn or not drawn together; one of them is enough
    share = min(1.0, rows / counts.sum())
    drawn = F.pmod(F.xxhash64(F.xxhash64("text"), F.lit(1)), F.lit(2**40)) < int(share * 2**40)
    sample = df.where(drawn).select("text").dropDuplicates(["text"])

    def learn(batches):
        texts = [text or "" for batch in batches for text in batch["text"].to_pylist()]
        if texts:
            texts.sort()  # so that the order of arrival does not matter
            target = np.array([probability.get(_pattern(votes(text)), 0.5) for text in texts])
            weights = fit(texts, target)
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], ["weights"])

    fitted = sample.coalesce(1).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(fitted[0].weights) if fitted else np.zeros(BUCKETS + 1)


def scorer(df: DataFrame, weights: np.ndarray):
    """Text column to probability of good. Texts without words are worth nothing."""
    held = df.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        out, w = [], held.value
        for text in texts:
            tokens = (text or "").split()
            at, value = features(tokens) if tokens else (np.zeros(0, int), np.zeros(0))
            out.append(1 / (1 + np.exp(-np.clip(w[at] @ value + w[BUCKETS], -30, 30))) if tokens else 0.0)
        return pd.Series(out, dtype=float)

    return quality


def keeps(quality: Column) -> Column:
    return quality >= REJECTED


def score(df: DataFrame) -> DataFrame:
    """(doc_id, text) to doc_id, quality and kept: one row per row of ``df``.

    Null, empty and blank texts have quality 0. Equal texts have equal quality; repeated rows and null ids
    are rows like others. An empty table gives no rows; other columns are not read.
    """
    weights = train(df)
    quality = scorer(df, weights)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), quality("text").alias("quality"))
    return rows.withColumn("kept", keeps(F.col("quality")))


def of_quality(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that are kept; columns unchanged."""
    quality = scorer(df, train(df))
    rows = df.select(F.struct("*").alias("row"), quality("text").alias("quality"))
    return rows.where(keeps(F.col("quality"))).select("row.*")


def op5_quality(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
