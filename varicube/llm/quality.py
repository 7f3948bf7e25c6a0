"""Quality classifier: labelling heuristics weighed by expectation-maximisation, whose posteriors train a hashed linear scorer."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from varicube.llm.common import sliced, unused
from varicube.llm.features import features, fit_softmax, posteriors

GOOD, BAD, ABSTAIN = 1, 0, -1
SIGNS = "#*%$&|!~^<>{}[]\\"


MEASURES = ("signs", "signed_words", "capitals", "upper_words", "distinct_words", "distinct_pairs", "stops", "word_size")
IS_SIGN = np.zeros(256, bool)
IS_SIGN[np.frombuffer(SIGNS.encode(), np.uint8)] = True
IS_SPACE = np.zeros(256, bool)
IS_SPACE[np.frombuffer(b" \t\n\r\x0b\f", np.uint8)] = True


def measures(text: str) -> list[float]:
    """What the labellers look at, in the order of MEASURES; each is not a number where there is too little text to say."""
    data = text.encode("utf-8", "surrogatepass")
    words, raw = data.split(), np.frombuffer(data, np.uint8)
    n, k = len(raw), len(words)
    if not k:
        return [math.nan] * len(MEASURES)
    sign, upper, lower = IS_SIGN[raw], (raw >= 65) & (raw <= 90), ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    space = IS_SPACE[raw]
    word = np.cumsum(~space & np.concatenate([[True], space[:-1]]))  # the number of each byte's word
    per_word = lambda mask: np.bincount(word[mask], minlength=k + 1) > 0
    shouted = (np.bincount(word[upper], minlength=k + 1) > 1) & ~per_word(lower)
    ends = np.flatnonzero(np.concatenate([space[1:], [True]]) & ~space)
    return [
        sign.sum() / n,
        per_word(sign).sum() / k if k >= 5 else math.nan,
        upper.sum() / n if n >= 20 else math.nan,
        shouted.sum() / k if k >= 5 else math.nan,
        len(set(words)) / k if k >= 30 else math.nan,
        len(set(zip(words, words[1:]))) / k if k >= 30 else math.nan,
        (raw[ends] == 46).sum() / k if k >= 15 else math.nan,
        n / k if k >= 5 else math.nan,
    ]


LABELLERS = ("signs", "signed_words", "capitals", "upper_words", "distinct_words", "distinct_pairs", "stops", "word_size", "prose")


def votes(m: np.ndarray) -> np.ndarray:
    """Votes (rows, LABELLERS) on measures (rows, MEASURES).

    Most labellers can only say bad or nothing; they overlap, so that each kind of bad text is seen by more than one. A measure
    that is not a number makes no vote.
    """
    signs, signed, capitals, upper, words, pairs, stops, size = m.T
    bad = [signs > 0.03, signed > 0.1, capitals > 0.2, upper > 0.2, (words < 0.3) & (pairs < 0.6), pairs < 0.4, stops > 0.6, (size > 16) | (size < 2.5)]
    orderly = (signs < 0.015) & (capitals < 0.1) & (pairs > 0.6) & (stops >= 0.01) & (stops <= 0.35)
    bad.append((signs > 0.03) | (capitals > 0.2) | (pairs < 0.4))
    out = np.where(np.stack(bad, 1), BAD, ABSTAIN)
    out[:, -1] = np.where(bad[-1], BAD, np.where(orderly, GOOD, ABSTAIN))
    return out


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Class-conditional shares (labeller, class, outcome) and the share of bad, by EM over the vote patterns and their counts.

    Labellers are taken as independent given the class. It starts from the votes cast: likely bad with any vote for it. A prior
    worth a fiftieth of the documents holds every labeller to be right more often than wrong, so that the classes keep their meaning.
    """
    bad = np.where((patterns == BAD).any(1), 0.9, 0.03)
    prior_counts = counts.sum() / 50 * np.array([[0.5, 0.02, 0.48], [0.02, 0.5, 0.48]])
    for _ in range(rounds):
        resp = np.stack([bad, 1 - bad], 1) * counts[:, None]
        prior = (resp[:, 0].sum() + 1) / (counts.sum() + 2)
        shares = np.stack([np.stack([(resp * (patterns[:, [j]] == o)).sum(0) for o in (BAD, GOOD, ABSTAIN)], 1) + prior_counts for j in range(patterns.shape[1])]) + 0.5
        shares /= shares.sum(2, keepdims=True)
        bad = posterior_bad(patterns, shares, prior)
    return shares, prior


def posterior_bad(patterns: np.ndarray, shares: np.ndarray, prior: float) -> np.ndarray:
    outcome = np.where(patterns == BAD, 0, np.where(patterns == GOOD, 1, 2))
    logs = np.log([[prior, 1 - prior]]) + sum(np.log(shares[j, :, outcome[:, j]]) for j in range(patterns.shape[1]))
    return 1 / (1 + np.exp(np.clip(logs[:, 1] - logs[:, 0], -50, 50)))


def buckets(row) -> tuple[int, ...]:
    """Hashed tokens of the measures: which measure, and in which of ten bins its square root falls."""
    out = []
    for k, value in enumerate(row):
        if value is not None and not (isinstance(value, float) and math.isnan(value)):
            out.append(100 * (k + 1) + int(min(9, max(0, 10 * math.sqrt(abs(value))))))
    return tuple(out)


def fitted_scorer(docs: DataFrame, sample: int):
    """A function from texts to the scorer's probabilities that they are good; None for an empty table.

    Vote patterns are counted over all documents (at most 2 to the power of the number of labellers, times 3 for the one that can say
    good), EM runs over these counts. The scorer is fitted, in one task, to the posteriors of a sample of at most about `sample` documents
    chosen by the hash of their ids and texts, never over twice as many.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def measured(pdf: pd.DataFrame) -> np.ndarray:
        return np.array([measures(t) for t in pdf["text"]]).reshape(len(pdf), len(MEASURES))

    def cast(batches):
        for pdf in sliced(batches):
            found, n = np.unique(votes(measured(pdf)), axis=0, return_counts=True)
            yield pd.DataFrame({"votes": list(found), "n": n})

    patterns = texts.mapInPandas(cast, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    counted = patterns.collect()  # bounded by the number of patterns
    if not counted:
        return None
    total = sum(r["n"] for r in counted)
    shares, prior = fit_label_model(np.array([r["votes"] for r in counted]), np.array([r["n"] for r in counted], float))
    one_in = max(1, -(-total // sample))
    chosen = texts.where(F.pmod(F.xxhash64(F.lit(3), "doc_id", "text"), F.lit(one_in)) == 0).limit(2 * sample)

    def vectors(pdf: pd.DataFrame, m: np.ndarray) -> np.ndarray:
        return np.stack([features(t, buckets(r)) for t, r in zip(pdf["text"], m.tolist())])

    def described(batches):
        for pdf in sliced(batches):
            if len(pdf):
                m = measured(pdf)
                yield pd.DataFrame({"x": [r.tobytes() for r in vectors(pdf, m)], "bad": posterior_bad(votes(m), shares, prior)})

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        x, bad = np.stack([np.frombuffer(r, np.float32) for r in pdf["x"]]), pdf["bad"].to_numpy()
        return pd.DataFrame({"w": [fit_softmax(x, np.stack([bad, 1 - bad], 1)).tobytes()]})

    fitted = chosen.mapInPandas(described, "x binary, bad double").groupBy().applyInPandas(train, "w binary").first()
    weights = np.frombuffer(fitted["w"], np.float64).reshape(-1, 2) if fitted else None

    def good(texts: list[str]) -> np.ndarray:
        if not texts or weights is None:
            return np.ones(len(texts))
        pdf = pd.DataFrame({"text": texts})
        return np.where((pdf["text"] == "").to_numpy(), 1.0, posteriors(vectors(pdf, measured(pdf)), weights)[:, 1])

    return good


def scored(docs: DataFrame, sample: int, name: str) -> DataFrame:
    """`docs` with the column `name`, the quality of each row's text."""
    good = fitted_scorer(docs, sample)
    if good is None:
        return docs.withColumn(name, F.lit(1.0))
    text_at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        for batch in sliced(batches):
            texts = ["" if t is None else t for t in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good(texts), pa.float64())], [*batch.schema.names, name])

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, sample: int = 6_000) -> DataFrame:
    """(doc_id, quality, keep) per row: the scorer's probability that the text is good (see fitted_scorer()), and whether it is at least one half.

    Every whole text is scored. Empty and null texts have no votes and count as good, as nothing is held against them. Repeated rows and null ids keep their rows.
    """
    return scored(docs.select("doc_id", "text"), sample, "quality").select("doc_id", "quality", (F.col("quality") >= 0.5).alias("keep"))


def keep_good(docs: DataFrame, sample: int = 6_000) -> DataFrame:
    """`docs` without the rows that the classifier rejects, each judged by its own text; ids are not looked at. One pass, without a join."""
    name = unused("quality", docs)
    return scored(docs, sample, name).where(F.col(name) >= 0.5).select(*docs.columns)
