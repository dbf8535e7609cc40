"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1; the boundary between words counts as a letter. An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rotated) once for every letter that follows it. A document's vector
bundles (adds) the vectors of all its n-grams, a language's prototype bundles the unit vectors of its documents, and
the nearest prototype by cosine names the language.

A document is profiled by its distinct n-grams and their counts, so its cost is one pass over the text and one small
matrix product. Letter vectors come from a seeded generator: every task makes the same.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import doc_id_fold

DIM = 1024
N = 3
SEED = 3
KNOWN_GRAMS = 16_384  # vectors kept in a task, 64 MB; emptied when full
UNKNOWN = "und"
SLICE = 1 << 20  # letters profiled at once


class Grams:
    """Vectors of n-grams, made when first met."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.is_letter: dict[int, int] = {}
        self._empty()

    def _empty(self) -> None:
        self.row: dict[int, int] = {}
        self.vectors = np.empty((256, DIM), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([SEED, code]).choice(np.array([-1, 1], np.float32), DIM)
        return self.letters[code]

    def _add(self, gram: int) -> int:
        codes = [gram >> 21 * (N - 1 - k) & 0x1FFFFF for k in range(N)]
        bound = np.ones(DIM, np.float32)
        for k, code in enumerate(codes):
            bound = bound * np.roll(self._letter(code), N - 1 - k)
        row = len(self.row)
        if row == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
        self.vectors[row] = bound
        self.row[gram] = row
        return row

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if len(self.row) + len(grams) > KNOWN_GRAMS:
            self._empty()
        known, add = self.row, self._add
        rows = [known[g] if g in known else add(g) for g in grams.tolist()]
        return counts.astype(np.float32) @ self.vectors[rows]


def codes_of(text: str) -> np.ndarray:
    """Lower-case letters' code points, with one 0 for everything between words, and at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    present = np.flatnonzero(np.bincount(codes))
    other = [c for c in present.tolist() if not chr(c).isalpha()]
    if other:
        keep = np.ones(present[-1] + 1, bool)
        keep[other] = False
        codes = codes * keep[codes]
    codes = np.concatenate([[0], codes, [0]])
    return codes[(codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0)]


def profile(text: str | None, grams: Grams) -> np.ndarray | None:
    """The document's vector scaled to unit length; None if it has no letter."""
    if not text:
        return None
    total = np.zeros(DIM, np.float32)
    found = False
    for k in range(0, len(text), SLICE):
        codes = codes_of(text[k : k + SLICE])
        if len(codes) < N:
            continue
        found = True
        keys = codes[: len(codes) - N + 1].copy()
        for i in range(1, N):
            keys = (keys << 21) | codes[i : len(codes) - N + 1 + i]
        distinct, counts = np.unique(keys, return_counts=True)
        for j in range(0, len(distinct), KNOWN_GRAMS):
            total += grams.bundle(distinct[j : j + KNOWN_GRAMS], counts[j : j + KNOWN_GRAMS])
    length = float(np.sqrt(total @ total))
    return total / length if found and length > 0 else None


def prototypes(documents: DataFrame, per_language: int) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, as rows of unit length, learnt from ``text, lang``.

    At most about ``per_language`` documents of a language are learnt from, picked by hash of id and text, so that rows
    without an id or of one id are drawn one by one; a language's documents are bundled in one task. The driver holds
    DIM numbers a language.
    """
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return [], np.zeros((0, DIM), np.float32)
    shares = F.from_json(F.lit(json.dumps({k: per_language / n for k, n in counts.items()})), "map<string,double>")
    picked = F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(picked < shares[F.col("lang")]).select("lang", "text")

    def bundle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        grams = Grams()
        total = np.zeros(DIM, np.float64)
        for text in rows["text"].sort_values():  # an order of its own, so that reruns add up alike
            if (vector := profile(text, grams)) is not None:
                total += vector
        return pd.DataFrame({"lang": [key[0]], "vector": [total]})

    learnt = sample.groupBy("lang").applyInPandas(bundle, "lang string, vector array<double>").toPandas()
    learnt = learnt.sort_values("lang")
    if not len(learnt):
        return [], np.zeros((0, DIM), np.float32)
    matrix = np.stack(learnt["vector"].map(np.asarray))
    length = np.sqrt((matrix * matrix).sum(axis=1))
    some = length > 0
    return learnt["lang"][some].tolist(), (matrix[some] / length[some, None]).astype(np.float32)


def identify(documents: DataFrame, per_language: int = 1500, folds: int = 4, test_fold: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``documents``.

    Learns from documents outside ``test_fold`` that have a language; only the text is an input of a prediction.
    ``score`` is the cosine with the nearest prototype, not below 0. A text that is null or has no letter, and every
    text when nothing was learnt: ``und`` with score 0. Ties: the smallest language. Null doc_id: fold 0. Repeated
    rows: a row each. Very long texts are profiled whole, a million letters at a time. Empty table: empty result. Other columns are ignored.
    """
    held_out = doc_id_fold(folds) == test_fold
    names, matrix = prototypes(documents.where(~held_out).select("doc_id", "text", "lang"), per_language)
    sent = documents.sparkSession.sparkContext.broadcast((names, matrix))  # 4 kB a language

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, matrix = sent.value
        grams = Grams()
        for batch in batches:
            found = []
            for text in batch["text"]:
                vector = profile(text, grams) if names else None
                if vector is None:
                    found.append((UNKNOWN, 0.0))
                else:
                    cosines = matrix @ vector
                    best = int(cosines.argmax())
                    found.append((names[best], float(min(1, max(0, cosines[best])))))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "held_out": batch["held_out"],
                    "lang_pred": [f[0] for f in found],
                    "score": [f[1] for f in found],
                }
            )

    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    return rows.mapInPandas(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")
