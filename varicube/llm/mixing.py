"""Mixing to target weights: domain posteriors, and document rates fitted by distributed projected gradients."""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from varicube.llm.common import save, sliced, unused
from varicube.llm.features import features, fit_softmax, posteriors

#: The share of tokens that each domain shall have.
TARGETS = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}


def fit_domains(labelled: DataFrame, domains: list[str], sample: int) -> np.ndarray | None:
    """Weights of a softmax over hashed features, fitted in one task to at most about `sample` labelled rows a domain, chosen by the hash of their ids and texts, never over twice as many. None without labelled rows."""
    known = labelled.where(F.col("domain").isin(domains))
    sizes = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a domain
    if not sizes:
        return None
    one_in = F.coalesce(*[F.when(F.col("domain") == d, F.lit(max(1, -(-n // sample)))) for d, n in sizes.items()])
    chosen = known.where(F.pmod(F.xxhash64(F.lit(5), "doc_id", "text"), one_in) == 0).limit(2 * sample * len(domains))

    def described(batches):
        for pdf in sliced(batches):
            yield pd.DataFrame({"x": [features(t).tobytes() for t in pdf["text"]], "domain": pdf["domain"]})

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(r, np.float32) for r in pdf["x"]])
        y = (pdf["domain"].to_numpy()[:, None] == np.array(domains)[None, :]).astype(float)
        y /= np.maximum(1, y.sum(0)) / (len(y) / len(domains))  # domains weigh alike
        y /= y.sum(1, keepdims=True)
        return pd.DataFrame({"w": [fit_softmax(x, y).tobytes()]})

    weights = chosen.select("text", "domain").mapInPandas(described, "x binary, domain string").groupBy().applyInPandas(train, "w binary").first()
    return np.frombuffer(weights["w"], np.float64).reshape(-1, len(domains)) if weights else None


def with_posteriors(docs: DataFrame, w: np.ndarray | None, domains: list[str], tokens: str, p: str) -> DataFrame:
    """`docs` with the columns `tokens`, the number of words of each row's text, and `p`, the posteriors of the domains in the given order; uniform without weights."""
    text_at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        for batch in sliced(batches):
            texts = ["" if t is None else t for t in batch.column(text_at).to_pylist()]
            found = posteriors(np.stack([features(t) for t in texts]), w) if texts and w is not None else np.full((len(texts), len(domains)), 1 / len(domains))
            added = [pa.array([float(len(t.split())) for t in texts], pa.float64()), pa.array(list(found.astype(float)), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, tokens, p])

    schema = StructType([*docs.schema.fields, StructField(tokens, DoubleType()), StructField(p, ArrayType(DoubleType()))])
    return docs.mapInArrow(run, schema)


def rate(steps: list[np.ndarray], posterior: str = "p") -> Column:
    """A document's rate after the gradient steps so far: from one, less its posterior's product with each step, never below zero."""
    p = F.col(posterior)
    out = F.lit(1.0)
    if not steps:
        return out
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in steps])
    return F.aggregate(rows, out, lambda r, s: F.greatest(F.lit(0.0), r - F.aggregate(F.zip_with(p, s, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)))


def fit_rates(table: DataFrame, targets: list[float], rounds: int = 60, tolerance: float = 1e-4, headroom: float = 1.05) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Steps for rate(), the totals reached, and the target totals of tokens a domain.

    Minimises the squared error of the expected totals, each weighed by its target, over rates of zero and above. A step
    moves a document's rate by the product of its posterior with the errors, then projects it. The errors are scaled by the curvature over
    the documents whose rates are above zero, so a domain's share does not slow it down; where that does not lower the error, by the largest
    curvature (the plain gradient, which always does unless the minimum is reached). Each round is one aggregation over all documents; only sums by
    domain reach the driver. The targets' grand total is `headroom` times the least for which no domain has to lose tokens, so that
    rates stay above one where they can. Rounds end within `tolerance` of every target; if no rates reach it, or `rounds` do not, a warning says what was reached.
    """
    d = len(targets)

    def look(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        p = [F.col("tokens") * F.element_at("p", i + 1) for i in range(d)]
        free = F.when(F.col("r") > 0, 1.0).otherwise(0.0)
        sums = [F.sum(x * F.col("r")) for x in p]
        cross = [F.sum(x * F.element_at("p", j + 1) * free) for x in p for j in range(d)]
        found = [x or 0.0 for x in table.select("tokens", "p", rate(steps).alias("r")).agg(*sums, *cross).first()]
        return np.array(found[:d]), np.array(found[d:]).reshape(d, d)

    now, gram = look([])
    share = np.array(targets) / sum(targets)
    wanted = share * (now / share).max() * headroom
    if not now.any():
        return [], now, wanted
    weight = 1.0 / np.maximum(wanted, 1e-9)
    plain = 1.0 / np.abs(np.linalg.eigvals(gram * weight[:, None])).max()
    steps: list[np.ndarray] = []
    while np.abs((now - wanted) * weight).max() >= tolerance:
        error = now - wanted
        merit = (weight * error**2).sum()
        scaled = np.linalg.lstsq(np.sqrt(weight)[:, None] * gram, np.sqrt(weight) * error, rcond=1e-10)[0]
        for step in (scaled, plain * weight * error):
            if (rounds := rounds - 1) < 0:
                break
            to, free = look([*steps, step])
            if (weight * (to - wanted) ** 2).sum() < merit * (1 - 1e-6):
                steps.append(step)
                now, gram = to, free
                break
        else:
            break
        if rounds < 0:
            break
    if np.abs((now - wanted) * weight).max() >= tolerance:
        warnings.warn(f"mixing: targets not reached; tokens by domain {now.round(1).tolist()}, wanted {wanted.round(1).tolist()}", RuntimeWarning, stacklevel=2)
    return steps, now, wanted


def fitted(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], sample: int, rounds: int) -> tuple[np.ndarray | None, DataFrame, list[np.ndarray]]:
    """The classifier's weights, the table (doc_id, tokens, p) and the steps of its rates."""
    domains = list(targets)
    w = fit_domains(labelled, domains, sample)
    table = save(with_posteriors(docs.select("doc_id", "text"), w, domains, "tokens", "p").drop("text"), "posteriors")
    steps, _, _ = fit_rates(table, [targets[d] for d in domains], rounds)
    return w, table, steps


def whole(rate_: Column) -> Column:
    """A rate, rounded up or down by the hash of the id, so that the copies are the rate on average."""
    u = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate_ + u).cast("int")


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, sample: int = 1_500, rounds: int = 60) -> DataFrame:
    """(doc_id, tokens, domain, posterior, rate, copies) per row of `docs`.

    labelled: doc_id, text, domain. domain and posterior: the likeliest domain and its share. Empty and null texts have no tokens and a rate by
    their posterior. Repeated and null ids keep their rows, each judged by its own text.
    """
    _, table, steps = fitted(docs, labelled, targets, sample, rounds)
    names = F.array(*[F.lit(d) for d in targets])
    rated = table.withColumn("rate", rate(steps))
    best = F.array_max("p")
    return rated.select("doc_id", F.col("tokens").cast("long").alias("tokens"), F.element_at(names, F.array_position("p", best).cast("int")).alias("domain"), best.alias("posterior"), "rate", whole(F.col("rate")).alias("copies"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, sample: int = 1_500, rounds: int = 60) -> DataFrame:
    """`docs` with each row as many times as its copies (see mixing_rates()); rows with a null doc_id stay once. Posteriors are taken anew in the writing pass, so no text is shuffled."""
    w, _, steps = fitted(docs, labelled, targets, sample, rounds)
    tokens, p, copy = (unused(c, docs) for c in ("tokens", "p", "copy"))
    rated = with_posteriors(docs, w, list(targets), tokens, p)
    copies = F.when(F.col("doc_id").isNull(), 1).otherwise(whole(rate(steps, p)))
    return rated.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies))).select(*docs.columns)
