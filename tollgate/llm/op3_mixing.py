"""Mixing to target weights with soft domain memberships.

1. A classifier trained on labelled documents gives every document a posterior over domains.
   The label table names the domain of some documents (``label_domain``); at most ``SAMPLE_ROWS``
   of them, those with the smallest hashes of their ids, train a multinomial logistic
   regression (Spark ML) on the words, word beginnings and word endings that documents hold.  Everything else covers all documents.
2. Projected gradient least squares finds rates r >= 0 (how often a document is to be used)
   such that the expected tokens of every domain, sum of r * tokens * posterior, meet their
   targets.  It starts at r = 1.  Residuals are weighted by the inverse mass of their domain, so
   rare domains count as much as common ones, and the gradient is taken in the metric of token
   counts, so the step for a document is minus its posterior times the weighted residuals.  An
   iteration is one pass over (tokens, posterior) that returns one number per domain; a rate
   follows from the residuals of all iterations, so no rate table is written in between.
3. Targets are weights times a total.  Without a given total, the anchor domain keeps its
   tokens (total = its expected tokens / its weight) and no document is used more than ``MOST``
   times: rates are held in [0, MOST], residuals are weighted by the inverse targets, so shares
   that such rates cannot reach come as near as they can in the chi-square distance.  Domains
   without tokens drop out and the others share their weight.  With a given total all targets
   hold as they are, and scarce domains are repeated without a bound.

``copies`` rounds a rate by a hash of doc_id and text: floor(rate), and one more with the
probability of the rest.

Tokens are words ``[^\\x20\\x09-\\x0D]+``.  Defined cases: null or empty texts have no tokens and
the posterior of an empty text; labels that are null, of unknown documents or repeated (the
smallest counts) do no harm; without labels the posterior is even and all rates are 1, with one labelled domain it
is that domain's; targets that no rates can meet
give rates whose loss is within ``LOSS`` of the least, shown by a dual bound, and a warning says when ``ITERATIONS`` end before; without tokens all rates are 1;
null doc_ids and repeated rows are each weighted; empty tables give empty results; ``mixed``
keeps other columns.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import table, text_batches, written
from .registry import register

#: Rows of the label table that train the classifier.
SAMPLE_ROWS = 2000
#: Slots of the hashed features, and how many of them the classifier weighs.
FEATURES = 1 << 15
CHOSEN = 300
#: The fit ends when all targets are met to TOLERANCE (of the total), or its loss is at most
#: 1 + LOSS times a lower bound of the least loss.
ITERATIONS = 400
#: Passes with the first step length, whatever the loss does.
EVEN_STEPS = 50
TOLERANCE = 1e-4
LOSS = 0.05
#: Domain -> share of the tokens.
TARGETS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}
ANCHOR = "good"
#: How often a document is used at most, without a given total.
MOST = 2.0


def label_domain() -> Column:
    """The domain that the label table gives a document."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor"))


def features(text: bytes | None) -> tuple[np.ndarray, int]:
    """(slots, words): hashed words, word beginnings and word endings that a text holds."""
    words = (text or b"").lower().split()
    seen = set(words)
    hashed = [*map(zlib.crc32, seen), *[zlib.crc32(w[:4], 1) for w in seen], *[zlib.crc32(w[-2:], 2) for w in seen]]
    return np.array(hashed, np.int64) % FEATURES, len(words)


@dataclass(frozen=True)
class Classifier:
    """Posteriors over ``domains``: softmax of the weights of the chosen slots and biases."""

    domains: tuple
    place: np.ndarray = field(repr=False)    # slot -> row of weights; the last row is zero
    weights: np.ndarray = field(repr=False)  # chosen slots + 1 by domains
    biases: np.ndarray = field(repr=False)

    @property
    def unlabelled(self) -> bool:
        """No labelled document: nothing tells the domains apart."""
        return len(self.weights) == 1 and not self.biases.any()

    def posterior(self, slots: np.ndarray) -> np.ndarray:
        z = self.biases + self.weights[np.unique(self.place[slots])].sum(axis=0)
        p = np.exp(z - z.max())
        return p / p.sum()


def train(docs: DataFrame, labels: DataFrame, domain: Column, domains: tuple, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Fits the classifier on at most ``sample_rows`` labelled documents: document frequencies
    choose CHOSEN slots by chi-square, logistic regression weighs them."""
    named = (labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("domain").alias("domain")))
    ids = docs.select("doc_id").distinct()
    sample = named.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # one text an id, so that rows that share a sampled id are no more training rows than ``sample_rows``
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("t")).select("domain", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1):
            slots = [np.unique(features(t)[0]).tolist() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slots, pa.list_(pa.int32()))], names=["domain", "slots"])

    checkpoint_dir(docs.sparkSession)
    label = F.element_at(F.create_map(*[F.lit(x) for i, d in enumerate(domains) for x in (d, i)]), F.col("domain"))
    data = rows.mapInArrow(run, "domain string, slots array<int>").select(label.alias("label"), "slots").checkpoint()
    n = {r.label: r["count"] for r in data.groupBy("label").count().collect()}
    there = sorted(n)
    biases = np.where([i in n or not n for i in range(len(domains))], 0.0, -50.0)
    none = Classifier(domains, np.zeros(FEATURES, np.int64), np.zeros((1, len(domains))), biases)
    if len(there) < 2:
        return none
    table_ = np.zeros((FEATURES, len(there)))  # documents that hold a slot, by domain
    for r in data.select("label", F.explode("slots").alias("slot")).groupBy("label", "slot").count().collect():
        table_[r.slot, there.index(r.label)] = r["count"]
    docs_of = np.array([n[i] for i in there], float)
    expected = table_.sum(axis=1, keepdims=True) * docs_of / docs_of.sum()
    away = docs_of - expected
    chi = ((table_ - expected) ** 2 * (1 / np.maximum(expected, 1e-9) + 1 / np.maximum(away, 1e-9))).sum(axis=1)
    chosen = np.sort(np.argsort(-chi, kind="stable")[:CHOSEN])
    place = np.full(FEATURES, len(chosen), np.int64)
    place[chosen] = np.arange(len(chosen))
    again = F.element_at(F.create_map(*[F.lit(float(x)) for i, k in enumerate(there) for x in (k, i)]), F.col("label").cast("double"))
    vector = F.transform(F.array(*[F.lit(int(c)) for c in chosen]), lambda c: F.array_contains("slots", c).cast("double"))
    model = LogisticRegression(family="multinomial", maxIter=30, regParam=0.001, standardization=False).fit(
        data.select(again.alias("label"), array_to_vector(vector).alias("features")))
    weights = np.zeros((len(chosen) + 1, len(domains)))
    weights[:-1, there] = model.coefficientMatrix.toArray().T
    biases[there] = model.interceptVector.toArray()
    return Classifier(domains, place, weights, biases)


def posteriors(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, n_tokens, p (the posterior, in the order of the domains) and draw of every row."""
    narrow = docs.select("doc_id", F.col("text").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1):
            got = [features(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n for _, n in got], pa.int64()),
                pa.array([classifier.posterior(s) for s, _ in got], pa.list_(pa.float64())),
                pa.array([draw(i, t) for i, t in zip(batch.column(0).to_pylist(), texts)], pa.int64())], names=["doc_id", "n_tokens", "p", "draw"])

    return narrow.mapInArrow(run, "doc_id long, n_tokens long, p array<double>, draw long")


def _replay(p: np.ndarray, steps: list, most: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given steps ((one value a domain, fresh) each) for rows of posteriors, and
    the point ahead of them at which the next gradient is taken (Nesterov's acceleration, without
    momentum from before a fresh step)."""
    r = ahead = np.ones(len(p))
    t = 1.0
    for step, fresh in steps:
        if fresh:
            ahead, t = r, 1.0
        new = np.clip(ahead - p @ step, 0.0, most)
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = new + (t - 1) / after * (new - r)
        r, t = new, after
    return r, ahead


def rates(p: np.ndarray, steps: list, most: float = np.inf) -> np.ndarray:
    return _replay(p, steps, most)[0]


def _totals(scored: DataFrame, k: int, steps: list, most: float = np.inf,
            slope: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """Expected tokens of each domain at the rates after ``steps`` and at the point ahead,
    the k by k matrix of tokens times posterior times posterior over documents with rates inside
    their bounds, and of the documents' values
    posterior times ``slope`` the sum of tokens times negative part and the least."""
    slope = np.zeros(k) if slope is None else slope

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, least = np.zeros(2 * k + k * k + 1), 0.0
        for batch in batches:
            n = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            p = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(-1, k)
            r, ahead = _replay(p, steps, most)
            total[:k] += (r * n) @ p
            total[k:2 * k] += (ahead * n) @ p
            free = n * ((r > 0) & (r < most))
            total[2 * k:-1] += ((p * free[:, None]).T @ p).ravel()
            value = np.minimum(p @ slope, 0.0) * (n > 0)
            total[-1] += n @ value
            least = min(least, value.min(initial=0.0))
        yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in (*total, least)], names=[*names, "least"])

    names = [f"s{i}" for i in range(2 * k + k * k + 1)]
    sums = scored.select("n_tokens", "p").mapInArrow(run, ", ".join(f"{c} double" for c in [*names, "least"]))
    row = np.array([x or 0.0 for x in sums.agg(*[F.sum(c).alias(c) for c in names], F.min("least")).first()])
    return row[:k], row[k:2 * k], row[2 * k:-2].reshape(k, k), row[-2], row[-1]


def _least_loss(goal: np.ndarray, scale: np.ndarray, slope: np.ndarray, most: float, below: float, least: float) -> float:
    """A lower bound of the loss of any rates, by duality from a slope (scale times residuals):
    ``below`` and ``least`` are what ``_totals`` says of it."""
    on = scale > 0
    if most < np.inf:
        return most * below - slope @ goal - 0.5 * (slope[on] ** 2 / scale[on]).sum()
    slope = slope - least  # posteriors sum to one: no document has a value below zero now
    return 0.5 * max(0.0, -slope @ goal) ** 2 / max((slope[on] ** 2 / scale[on]).sum(), 1e-300)


def fit(scored: DataFrame, domains: tuple, targets: dict, anchor: str, total: float | None = None,
        iterations: int = ITERATIONS, tolerance: float = TOLERANCE, most: float = np.inf) -> list:
    """The steps of the projected gradient; ``rates`` turns them into rates of at most ``most``.
    Steps begin with the length that is safe for all documents.  After ``EVEN_STEPS`` the length follows the
    documents whose rates are still inside their bounds, which lets it grow as others settle
    there; a step that raises the loss is taken back, and the next one starts without momentum."""
    k = len(domains)
    weights = np.array([targets[d] for d in domains], float)
    have, ahead, h, *_ = _totals(scored, k, [])
    tokens = have.sum()
    if not tokens:
        return []
    bounded = most < np.inf
    if bounded:
        weights = np.where(have > 1e-9 * tokens, weights, 0.0)
        if not weights.sum():
            return []
    at = domains.index(anchor)
    if total is None:
        total = have[at] / (weights[at] / weights.sum()) if have[at] and weights[at] else tokens
    goal = weights / weights.sum() * total
    scale = 1 / np.maximum(np.diag(h), 1e-12 * tokens)  # residuals count by the mass of their domain
    if bounded:  # by their targets; not those of domains without tokens
        scale = np.where(have > 1e-9 * tokens, 1 / np.maximum(goal, 1e-3 * total), 0.0)
    root = np.sqrt(scale)

    def length(h: np.ndarray) -> float:
        return 1 / max(np.linalg.eigvalsh(root[:, None] * h * root[None, :])[-1], 1e-12)

    def loss_of(x: np.ndarray) -> float:
        return 0.5 * float(scale @ (x - goal) ** 2)

    every, least_length = h, length(h)
    size, fresh, passes = least_length, False, 0
    steps: list = []
    bound = -np.inf
    while np.abs(have - goal)[scale > 0].max() > tolerance * total:
        loss = loss_of(have)
        if loss <= (1 + LOSS) * bound:  # as near as rates can come
            break
        if passes >= iterations:
            warnings.warn(f"mixing: not settled after {iterations} iterations: loss {loss:.6g}, least loss {bound:.6g} or more, "
                          f"tokens {dict(zip(domains, have.tolist()))}, targets {dict(zip(domains, goal.tolist()))}", stacklevel=2)
            break
        slope = scale * (have - goal)
        trial = [*steps, (size * scale * ((have if fresh else ahead) - goal), fresh)]
        new, new_ahead, free, below, least = _totals(scored, k, trial, most, slope)
        passes += 1
        bound = max(bound, _least_loss(goal, scale, slope, most, below, least))
        if passes > EVEN_STEPS and loss_of(new) > loss:
            if fresh and size <= least_length:
                break  # rounding: no step lowers the loss any more
            size, fresh = max(least_length, size / 2) if fresh else size, True
            continue
        steps, have, ahead, fresh = trial, new, new_ahead, False
        if passes >= EVEN_STEPS:
            size = length(free + 1e-9 * every)
    return steps


def _copies(rate: np.ndarray, draws: list) -> np.ndarray:
    """Rates rounded at random, by a draw for each row."""
    u = np.array([zlib.crc32(b"mix%d" % d) for d in draws], float) / 2**32
    return np.floor(rate + u).astype(np.int64)


def draw(doc_id: int | None, text: bytes | None) -> int:
    """A number from a row's id and text: rows that share an id, or have none, are rounded apart
    (rows equal in both are the same document and are rounded alike)."""
    return zlib.crc32(text or b"", zlib.crc32(b"%d" % (doc_id if doc_id is not None else -1)))


def mixture(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict | None = None, anchor: str = ANCHOR,
            total: float | None = None) -> tuple[Classifier, DataFrame, Callable]:
    """The classifier, the written table of posteriors, and the fitted rates of posteriors."""
    targets = targets or TARGETS
    classifier = train(docs, labels, label_domain(), tuple(sorted(targets)))
    scored = written(spark, posteriors(docs, classifier), "mix-posteriors")
    most = MOST if total is None else np.inf
    steps = [] if classifier.unlabelled else fit(scored, classifier.domains, targets, anchor, total, most=most)
    return classifier, scored, lambda p: rates(p, steps, most)


def document_rates(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict | None = None,
                   anchor: str = ANCHOR, total: float | None = None) -> DataFrame:
    """doc_id, domain (the likeliest), n_tokens, p_<domain>, rate and copies of every row."""
    classifier, scored, fitted = mixture(spark, docs, labels, targets, anchor, total)
    domains = classifier.domains

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array(batch.column(2).flatten().to_numpy(zero_copy_only=False)).reshape(-1, len(domains))
            rate = fitted(p)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([domains[i] for i in p.argmax(axis=1)], pa.string()), batch.column(1),
                *[pa.array(p[:, i]) for i in range(len(domains))], pa.array(rate), pa.array(_copies(rate, batch.column(3).to_pylist()))],
                names=["doc_id", "domain", "n_tokens", *[f"p_{d}" for d in domains], "rate", "copies"])

    shares = ", ".join(f"p_{d} double" for d in domains)
    return scored.mapInArrow(run, f"doc_id long, domain string, n_tokens long, {shares}, rate double, copies long")


def mixed(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict | None = None, anchor: str = ANCHOR,
          total: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its copies say."""
    classifier, _, fitted = mixture(spark, docs, labels, targets, anchor, total)
    at, key = docs.columns.index("text"), docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, at):
            p = np.array([classifier.posterior(features(t)[0]) for t in texts])
            n = _copies(fitted(p), [draw(i, t) for i, t in zip(batch.column(key).to_pylist(), texts)])
            yield batch.take(pa.array(np.repeat(np.arange(len(n)), n)))

    return docs.mapInArrow(run, docs.schema)


@register("op3_mix_sources")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_rates(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
