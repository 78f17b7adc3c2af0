"""Mixing to target weights with soft domain membership.

A classifier learned from a labelled table gives every document a share of each domain: naive Bayes over words and
word ends judges stretches of ``STRETCH`` words, and a document's posterior is the mean over its stretches.  The rates
are the nonnegative numbers, one for each document, that solve

    min  1/2 sum_k (S_k - T_k)^2 / g_k  +  ridge / 2 sum_d t_d (x_d - 1)^2,    S_k = sum_d x_d t_d p_dk

with tokens t_d (ids of the production tokenizer and the end id, as packed), posteriors p_dk and targets T_k as shares of all tokens, and g_k the share that domain k has
now.  Projected gradient steps are one aggregation each: only the K totals reach the driver, and a document's rate
follows from its posterior by taking the same steps.  The ridge keeps rates near 1 and makes the answer unique.  With
``most`` given, rates are projected on ``0 <= x <= most``, which bounds the copies of a row; ``reached`` tells which targets that
leaves unmet.

A row carries its columns, posterior and rate together through the whole job, so nothing is joined back by an id.

Defined cases: a text without words has no tokens and a rate of 1; it weighs nothing.  A domain no labelled document
has gets posterior 0; its target is out of reach and left unmet.  Without labelled rows all posteriors are equal.
Rows of a null or repeated id are each mixed by their own text; rows alike in id and text get equal rates and copies.  An empty
table gives no rows.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starblend.llm.common import _mix, steps, strings, word_hashes, word_spans
from starblend.llm.learn import labelled_sample
from starblend.llm.settings import END_ID, tokenizer_path
from starblend.llm.token_ids import encoder
from starblend.workspace import Workspace

BITS = 17
STRETCH = 16
#: Labelled rows learned from, for each domain.
SAMPLE = 1000
#: Rounds of the fit at the most; one that is not done by then warns and says so in ``Rates.converged``.
ROUNDS = 200


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashed places for each word, the word and its last three bytes, and each text's first word."""
    words, first = word_hashes(texts)
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    start, end = word_spans(joined)
    tail = sum(joined[np.maximum(end - 1 - i, start)].astype(np.uint64) << np.uint64(8 * i) for i in range(3)) if len(end) else words
    shift = np.uint64(64 - BITS)
    return np.stack([_mix(words + np.uint64(1)) >> shift, _mix(tail + np.uint64(1 << 32)) >> shift]).astype(np.int64), first


class Domains:
    """Log-probabilities of the hashed places under each domain."""

    def __init__(self, samples: list[list[bytes]], smooth: float = 0.1):
        k = len(samples)
        self.table = np.zeros((1 << BITS, k))
        self.known = np.array([bool(s) for s in samples])
        for j, texts in enumerate(samples):
            tally = np.full(1 << BITS, smooth)
            for lo, hi in steps(texts):
                places, _ = _features(texts[lo:hi])
                tally += np.bincount(places.ravel(), minlength=1 << BITS)
            self.table[:, j] = np.log(tally / tally.sum())

    def posteriors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words and domain shares of each text."""
        k = self.table.shape[1]
        counts, shares = [], []
        if not self.known.any():
            self.known[:] = True
        for lo, hi in steps(texts):
            places, first = _features(texts[lo:hi])
            n = np.diff(first)
            counts.append(n)
            out = np.tile(self.known / self.known.sum(), (hi - lo, 1))
            if places.shape[1]:
                logs = self.table[places[0]] + self.table[places[1]]
                owner = np.repeat(np.arange(hi - lo), n)
                within = (np.arange(len(owner)) - first[owner]) // STRETCH
                cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (within[1:] != within[:-1])])
                total = np.add.reduceat(logs, cut)
                total[:, ~self.known] = -np.inf
                share = np.exp(total - total.max(1, keepdims=True))
                share /= share.sum(1, keepdims=True)
                share *= np.diff(np.r_[cut, len(owner)])[:, None]
                full = np.flatnonzero(n)
                out[full] = np.stack([np.bincount(owner[cut], weights=share[:, j], minlength=hi - lo) for j in range(k)], 1)[full]
                out[full] /= n[full, None]
            shares.append(out)
        if not counts:
            return np.empty(0, np.int64), np.empty((0, k))
        return np.concatenate(counts), np.concatenate(shares)


def learn_domains(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> Domains:
    """A classifier from ``labelled`` (``doc_id, domain``) and the texts of ``docs``."""
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    named = labelled.where(F.col("domain").isin(*domains)).select("doc_id", number.cast("int").alias("label"))
    texts, _ = labelled_sample(docs, named, "label", dict.fromkeys(range(len(domains)), SAMPLE))
    return Domains([texts[i] for i in range(len(domains))])


def with_posteriors(docs: DataFrame, model: Domains, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``docs`` with ``n_tokens`` and the array ``posterior``; ``docs`` must have neither.  ``text`` goes.

    ``n_tokens`` counts the ids of ``tokenizer`` and the end id; a text without words has 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != "text"]

    def run(batches):
        ids_of = encoder(tokenizer, end_id)
        for batch in batches:
            texts = strings(batch.column("text"))
            words, share = shared.value.posteriors(texts)
            n = ids_of.lengths(texts) * (words > 0)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * share.shape[1], pa.int32()), pa.array(share.ravel()))
            yield pa.RecordBatch.from_arrays([*map(batch.column, columns), pa.array(n, pa.int64()), flat], names=[*columns, "n_tokens", "posterior"])
        ids_of.rest()

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.mapInArrow(run, f"{schema}, n_tokens long, posterior array<double>")


class Rates:
    """The gradient steps taken so far; a row's rate follows from its posterior by taking them again."""

    def __init__(self, step: float, ridge: float, most: float | None = None):
        self.step, self.ridge, self.most = step, ridge, most
        self.converged = False
        self.taken: list[tuple[np.ndarray, float]] = []

    def replay(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rates before the last step and after it, and the points where the last and the next gradient is taken."""
        before = x = at = ahead = np.ones(len(p))
        keep = self.step * self.ridge
        for pull, momentum in self.taken:
            before, at = x, ahead
            x = np.clip((1 - keep) * at - p @ pull + keep, 0.0, self.most)
            ahead = x + momentum * (x - before)
        return before, x, at, ahead


def _posteriors(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("posterior")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 1))


def fit_rates(
    rows: DataFrame, targets: list[float], ridge: float = 1e-3, tolerance: float = 1e-5, most: float | None = None, rounds: int = ROUNDS
) -> Rates | None:
    """Rates for ``rows`` (``n_tokens, posterior``) by projected gradient steps with momentum; None without tokens.

    A round is one pass that sums a few numbers.  It ends when the rates move by less than ``tolerance`` (root mean
    square over tokens), or with a warning after ``rounds`` rounds.
    """
    k = len(targets)
    weight = np.array(targets, float) / sum(targets)
    p = [F.get("posterior", F.lit(j)) for j in range(k)]
    t = F.col("n_tokens").cast("double")
    pairs = [F.sum(t * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    first = rows.agg(F.sum(t).alias("all"), *(F.sum(t * p[j]).alias(f"s{j}") for j in range(k)), *pairs).first()
    tokens = first["all"] or 0.0
    if not tokens:
        return None
    now = np.array([first[f"s{j}"] for j in range(k)]) / tokens
    gram = np.array([[first[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / tokens
    scale = np.where(now > 1e-12, 1 / np.maximum(now, 1e-12), 0.0)
    root = np.sqrt(scale)
    step = 1 / (float(np.linalg.eigvalsh(root[:, None] * gram * root[None, :])[-1]) + ridge)
    rates = Rates(step, ridge, most)

    def sums(batches):
        total = np.zeros(k + 2)
        for batch in batches:
            share, n = _posteriors(batch), batch.column("n_tokens").to_numpy().astype(float)
            if len(n):
                before, x, at, ahead = rates.replay(share)
                total += np.r_[(n * ahead) @ share, n @ ((at - x) * (x - before)), n @ (x - before) ** 2]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names=[f"v{j}" for j in range(k + 2)])

    shape = ", ".join(f"v{j} double" for j in range(k + 2))
    totals, age = now, 1.0
    for _ in range(rounds):
        following = (1 + np.sqrt(1 + 4 * age * age)) / 2
        rates.taken.append((step * scale * (totals - weight), (age - 1) / following))
        age = following
        found = rows.select("n_tokens", "posterior").mapInArrow(sums, shape).agg(*(F.sum(f"v{j}") for j in range(k + 2))).first()
        totals, turned, moved = np.array(found[:k]) / tokens, found[k], found[k + 1]
        if moved / tokens < tolerance**2:
            rates.converged = True
            break
        if turned > 0:  # the momentum points uphill: let it go, and take the next gradient at the rates themselves
            rates.taken[-1] = (rates.taken[-1][0], 0.0)
            age = 1.0
            found = rows.select("n_tokens", "posterior").mapInArrow(sums, shape).agg(*(F.sum(f"v{j}") for j in range(k))).first()
            totals = np.array(found[:k]) / tokens
    if not rates.converged:
        warnings.warn(f"mixing rates still moved after {rounds} rounds", stacklevel=2)
    return rates


def with_rates(rows: DataFrame, fitted: Rates | None) -> DataFrame:
    """``rows`` with a column ``rate``; 1 for a row without tokens."""
    if fitted is None:
        return rows.withColumn("rate", F.lit(1.0))
    columns = rows.columns

    def apply(batches):
        for batch in batches:
            x = fitted.replay(_posteriors(batch))[1]
            n = batch.column("n_tokens").to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.where(n > 0, x, 1.0))], names=[*columns, "rate"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(apply, f"{schema}, rate double")


def _with_copies(rated: DataFrame, *identity: str) -> DataFrame:
    """``rated`` with ``copies``: the rate rounded up or down by a hash, so that it is the rate in expectation."""
    chance = F.pmod(F.xxhash64(F.lit(9), *identity), F.lit(1 << 40)) / float(1 << 40)
    return rated.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def rates(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], work: Workspace, tokenizer: str | None = None, most: float | None = None
) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens``, ``posterior``, ``rate`` and ``copies``; ``docs`` must have none of them."""
    model = learn_domains(docs, labelled, list(targets))
    marked = docs.withColumn("_text", F.xxhash64("text"))
    rows = work.table(with_posteriors(marked, model, tokenizer or tokenizer_path()), "posteriors")
    rated = with_rates(rows, fit_rates(rows, list(targets.values()), most=most))
    return _with_copies(rated, "doc_id", "_text").drop("_text")


def reached(rated: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``domain, target, before, by_rates, by_copies``: shares of the tokens of ``rated`` (from ``rates``)."""
    names, wanted = list(targets), np.array(list(targets.values())) / sum(targets.values())
    each = F.explode(F.arrays_zip(F.array(*map(F.lit, names)).alias("domain"), F.col("posterior")))
    rows = rated.select("n_tokens", "rate", "copies", each.alias("of")).select("*", "of.domain", (F.col("n_tokens") * F.col("of.posterior")).alias("t"))
    sums = rows.groupBy("domain").agg(
        F.sum("t").alias("before"), F.sum(F.col("t") * F.col("rate")).alias("by_rates"), F.sum(F.col("t") * F.col("copies")).alias("by_copies")
    )
    whole = sums.agg(*(F.sum(c).alias(f"all_{c}") for c in ("before", "by_rates", "by_copies")))
    target = F.element_at(F.create_map(*(F.lit(v) for pair in zip(names, wanted.tolist(), strict=True) for v in pair)), F.col("domain"))
    return sums.join(F.broadcast(whole)).select(
        "domain", target.alias("target"), *(F.try_divide(F.col(c), F.col(f"all_{c}")).alias(c) for c in ("before", "by_rates", "by_copies"))
    )


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labelled documents: their language."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id").distinct(), "doc_id")


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], work: Workspace, most: float | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with all their columns."""
    model = learn_domains(docs, labelled, list(targets))
    columns = docs.columns
    plain = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), "text")
    rows = work.table(with_posteriors(plain, model, tokenizer_path()), "posteriors")
    rated = with_rates(rows, fit_rates(rows, list(targets.values()), most=most))
    hashed = rated.withColumn("hash", F.xxhash64(f"c{columns.index('text')}"))
    copied = _with_copies(hashed, f"c{columns.index('doc_id')}", "hash").where(F.col("copies") > 0)
    copied = copied.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copied.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
