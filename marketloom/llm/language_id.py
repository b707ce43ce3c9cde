"""Language ID (operator 9): the family first, then one-versus-one linear SVMs inside it.

Texts become hashed counts of byte bigrams and trigrams of the lower-cased whole text. The
models are fitted on a bounded sample of labelled rows; every row is then scored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, hidden, quoted

#: Rows that the models are fitted on, over all languages together, at most.
SAMPLE_ROWS = 1600
FEATURES = 4096
#: Scores of language and family are sigmoids of this times the margin.
STEEPNESS = 4.0
UNKNOWN = "und"

# ISO 639-1 codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi bn mr gu pa ur ne si",
    "semitic": "ar he mt am",
    "sinitic": "zh yue",
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

# ASCII characters other than letters all count as a space; other bytes stay.
_BYTES = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def features(text: str) -> np.ndarray:
    """Square roots of the hashed n-gram counts, of length one."""
    b = _BYTES[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
    two = b[:-1] << np.uint32(8) | b[1:]
    three = two[:-1] << np.uint32(8) | b[2:]
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    at = [((g + np.uint32(k << 24)) * np.uint32(2654435761)) >> shift for k, g in ((1, two), (2, three))]
    x = np.sqrt(np.bincount(np.concatenate(at), minlength=FEATURES).astype(np.float32))
    return x / max(float(np.linalg.norm(x)), 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 20) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss, by dual coordinate descent; y is 1 or -1."""
    rng, alpha, w = np.random.default_rng(0), np.zeros(len(y)), np.zeros(x.shape[1], np.float64)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            step = (y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * c)) / (1 + 1 / (2 * c))
            new = max(alpha[i] - step, 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w.astype(np.float32)


def _sure(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-STEEPNESS * np.clip(margin, -20, 20)))


@dataclass
class Model:
    """Weights by family (one against the rest) and by pair of languages of a family."""

    families: dict[str, list[str]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> Model:
        known = sorted(set(langs))
        families: dict[str, list[str]] = {}
        for code in known:
            families.setdefault(FAMILY.get(code, code), []).append(code)
        own = np.array([FAMILY.get(code, code) for code in langs])
        rest = [fit_svm(x, np.where(own == f, 1, -1)) if len(families) > 1 else np.zeros(FEATURES) for f in families]
        pairs = {}
        for codes in families.values():
            for a, b in itertools.combinations(codes, 2):
                of = (langs == a) | (langs == b)
                pairs[a, b] = fit_svm(x[of], np.where(langs[of] == a, 1, -1))
        return cls(families, np.array(rest), pairs)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, margins = list(self.families), x @ self.family_weights.T
        best = margins.argmax(axis=1)
        langs, score = np.empty(len(x), object), np.ones(len(x))
        if len(names) > 1:
            ordered = np.sort(margins, axis=1)
            score = _sure((ordered[:, -1] - ordered[:, -2]) / 2)
        for k, name in enumerate(names):
            of, codes = np.flatnonzero(best == k), self.families[name]
            votes = np.zeros((len(of), len(codes)))
            for a, b in itertools.combinations(range(len(codes)), 2):
                p = _sure(x[of] @ self.pair_weights[codes[a], codes[b]])
                votes[:, a] += p
                votes[:, b] += 1 - p
            won = votes.argmax(axis=1) if len(codes) > 1 else np.zeros(len(of), int)
            langs[of] = np.array(codes, object)[won]
            if len(codes) > 1:
                score[of] *= votes[np.arange(len(of)), won] / (len(codes) - 1)
        return langs, score


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame | None:
    """lang, text: at most ``rows`` distinct texts of ``docs``, equally many of each language.

    They are those of a language with the smallest hashes, all where it has no more; copies
    count once. Rows without a language or a letter are left out. None if there is no such row.
    Where there are more languages than ``rows``, those with the most texts are learned.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    labelled = labelled.select("lang", "text", F.xxhash64("text").alias("hash"))
    texts = checkpointed(labelled.select("lang", "hash").distinct())
    counts = texts.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows)
    counts = {r["lang"]: r["count"] for r in counts.collect()}
    if not counts:
        return None
    each = rows // len(counts)
    unit = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    # Hashes of distinct texts are even, so these shares hold enough of them, also where each is small.
    share = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(min((3 * each + 50) / n, 1.0))) for k, n in counts.items()))
    thinned = texts.withColumn("unit", unit).where(F.col("unit") <= share[F.col("lang")])
    place = F.expr("row_number() OVER (PARTITION BY lang ORDER BY unit, hash)")
    chosen = thinned.withColumn("place", place).where(F.col("place") <= each).select("lang", "hash")
    return labelled.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Models from a sample of ``docs`` (text, lang), see there. None if no row is labelled."""
    chosen = sample(docs, rows)
    if chosen is None:
        return None

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "x": [features(t).tobytes() for t in batch["text"]]})

    found = chosen.mapInPandas(encode, "lang string, x binary").toPandas()
    found = found.sort_values(["lang", "x"])
    return Model.fit(np.stack([np.frombuffer(v, np.float32) for v in found["x"]]), found["lang"].to_numpy())


def identify(docs: DataFrame, model: Model | None, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1), or as named, from the whole text alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every text where
    no model could be fitted. Own columns of these names are replaced, repeated rows stay.
    """
    docs = docs.select(*quoted([c for c in docs.columns if c.lower() not in (pred, score)]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Only texts go to Python and only predictions come back.
    @F.pandas_udf("lang string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            langs, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            texts = batch.tolist()
            of = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
            if model is not None:
                for k in range(0, len(of), 512):
                    part = of[k : k + 512]
                    langs[part], scores[part] = model.predict(np.stack([features(texts[i]) for i in part]))
            yield pd.DataFrame({"lang": langs, "score": scores})

    own = hidden(docs, "scored")["scored"]
    found = docs.withColumn(own, scored(docs["text"].cast("string")))
    return found.select(*quoted(docs.columns), found[own]["lang"].alias(pred), found[own]["score"].alias(score))


def held_out(docs: DataFrame):
    """Whether a row is kept from fitting: by the checksum of its id."""
    return F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))) % 3 == 1


def drop_unidentified(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """``docs`` without the rows that no language fits: without a letter, or with a score below ``min_score``.

    Where no row is labelled there is no model, and only rows without a letter go.
    """
    model = fit(docs.where(~held_out(docs)).select("text", "lang"))
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    own = hidden(docs, "pred", "score")
    found = identify(docs, model, own["pred"], own["score"])
    return found.where((F.col(own["pred"]) != UNKNOWN) & (F.col(own["score"]) >= min_score)).select(*quoted(docs.columns))
