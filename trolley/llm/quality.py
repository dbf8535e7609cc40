"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Tokens are words between white space. Features are the n-grams (one and two tokens) of two readings of a text: the
tokens themselves, and their shapes (letter case or digits, the punctuation around them, and a mark where a token
repeats the one before), so that habits such as shouting or stuttering carry over to words never seen. A feature's
value is one plus the logarithm of its count, scaled to unit length per document.

Training takes a bounded sample of labelled documents (``most_rows``, by hash of the id). They are dealt to a fixed
number of trainers; each makes per-coordinate FTRL-proximal updates over its own share, and the trainers' weights are
averaged. The model has 2**HASH_BITS weights whatever the corpus; only the non-zero ones travel to the scoring tasks.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from trolley.llm.common import doc_id_fold, materialise

HASH_BITS = 18
DIM = 1 << HASH_BITS
KNOWN_TOKENS = 100_000  # of the hash cache in a task; emptied when full
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Training:
    most_rows: int = 8_000  # labelled documents learnt from, at most (in expectation)
    trainers: int = 2
    passes: int = 4
    alpha: float = 8.0
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.0


def shape(token: str) -> str:
    """Case or kind of the letters, with up to three marks before and after them."""
    core = token.strip(string.punctuation)
    if not core:
        return token[:4]
    begin = token.find(core)
    if core.isdigit():
        case = "0"
    elif core.islower():
        case = "a"
    elif core.isupper():
        case = "A" if len(core) == 1 else "AA"
    else:
        case = "Aa" if core[0].isupper() and core[1:].islower() else "aA"
    return token[:begin][:3] + case + token[begin + len(core) :][:3]


class TokenHashes(dict):
    """Token to the hashes of itself (upper 32 bits) and of its shape. Remembers the tokens it has met, up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) >= KNOWN_TOKENS:
            self.clear()
        own = crc32(token.encode("utf-8", "surrogatepass")) << 32
        own |= crc32(b"shape:" + shape(token).encode("utf-8", "surrogatepass"))
        self[token] = own
        return own


class Features:
    """Hashed n-grams of texts."""

    def __init__(self):
        self.hashes = TokenHashes()

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers, ascending, and their values. Feature 0 is the bias, the only one of an empty text."""
        tokens = text.split() if text else []
        if not tokens:
            return np.zeros(1, np.int64), np.ones(1)
        both = np.fromiter(map(self.hashes.__getitem__, tokens), np.uint64, len(tokens))
        words, shapes = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        shapes[1:][words[1:] == words[:-1]] = 1  # a repeated token
        grams = [words * MIX, shapes * MIX + np.uint64(1)]
        grams += [(g[:-1] * np.uint64(31) + g[1:] + np.uint64(7)) * MIX for g in grams]
        index, count = np.unique(np.concatenate(grams) >> np.uint64(64 - HASH_BITS), return_counts=True)
        value = 1 + np.log(count)
        value /= np.sqrt(value @ value)
        return np.concatenate([[0], index.astype(np.int64)]), np.concatenate([[1.0], value])


def sigmoid(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def train(texts: list[str | None], labels: list[int], how: Training) -> np.ndarray:
    """Weights after FTRL-proximal passes over the documents in the given order."""
    z, n = np.zeros(DIM), np.zeros(DIM)
    features = Features()
    rows = [features.of(t) for t in texts]

    def weights(i: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - how.l1, 0)
        return -shrunk / ((how.beta + np.sqrt(n[i])) / how.alpha + how.l2)

    for _ in range(how.passes):
        for (i, x), y in zip(rows, labels, strict=True):
            w = weights(i)
            g = (sigmoid(w @ x) - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / how.alpha * w
            n[i] += g * g
    return weights(np.arange(DIM))


def fit(labelled: DataFrame, how: Training = Training()) -> pd.DataFrame:
    """Weights (index, weight) learnt from ``doc_id, text, label`` (0 or 1). Null labels teach nothing. No labelled row
    gives no weight: every score is then one half. The result has at most 2**HASH_BITS rows."""
    spark: SparkSession = labelled.sparkSession
    labelled = labelled.where("label in (0, 1)")
    known = labelled.select("doc_id", "label").count()
    share = min(1.0, how.most_rows / max(known, 1))
    order = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30))
    sample = labelled.where(order < F.lit(int(share * (1 << 30))))
    sample = sample.select("doc_id", "text", "label", order.alias("order"))
    trainers = sample.withColumn("trainer", F.pmod(F.col("order"), F.lit(how.trainers)))

    def learn(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "doc_id"], kind="stable")
        w = train(rows["text"].tolist(), rows["label"].tolist(), how)
        i = np.flatnonzero(w)
        return pd.DataFrame({"index": i, "weight": w[i]})

    # A trainer's group is bounded by most_rows / trainers rows.
    learnt = trainers.groupBy("trainer").applyInPandas(learn, "index bigint, weight double")
    averaged = learnt.groupBy("index").agg((F.sum("weight") / how.trainers).alias("weight"))
    model = materialise(averaged, "quality-model").orderBy("index").toPandas()
    assert len(model) <= DIM
    return model


def scores(model: pd.DataFrame, spark: SparkSession):
    """A column function: probability of label 1 of a text."""
    dense = np.zeros(DIM, np.float32)
    dense[model["index"].to_numpy(np.int64)] = model["weight"].to_numpy(np.float32)
    sent = spark.sparkContext.broadcast(dense)  # 1 MB, whatever the corpus

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, features = sent.value, Features()
        for texts in batches:
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                i, x = features.of(text)
                out[k] = sigmoid(float(weights[i] @ x))
            yield pd.Series(out)

    return score


def labelled_documents(documents: DataFrame, labels: DataFrame, column: str, fold: Column) -> DataFrame:
    """Training rows: documents in ``fold`` with their label. Conflicting labels of one id: the smallest counts."""
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & fold)
    known = known.groupBy("doc_id").agg(F.min(column).alias("label"))
    return documents.where(fold).select("doc_id", "text").join(known, "doc_id")


def score_documents(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """All rows and columns of ``documents`` with ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 from ``threshold`` on); these replace columns of the same name.

    Learns from documents outside fold 0 only; nothing but the text is an input of a score. Null and empty texts have
    the bias as their only feature. Null doc_id: fold 0, never learnt from. Repeated rows teach and are scored once
    each; equal texts have equal scores. Very long texts are scored whole, in the memory of one task. Empty tables: no training rows give 0.5 for every text.
    """
    model = fit(labelled_documents(documents, labels, "quality", doc_id_fold(folds) != 0))
    score = scores(model, documents.sparkSession)
    scored = documents.withColumn("score", score(F.col("text"))).withColumn("held_out", doc_id_fold(folds) == 0)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
