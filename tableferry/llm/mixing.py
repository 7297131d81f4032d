"""Mixing to target weights by soft membership, in built-in functions only.

A classifier learned from a labelled table (naive Bayes over ``BUCKETS`` hashed words) gives every document a
posterior over domains. Then rates r >= 0 are fitted by projected-gradient least squares so that the
expected tokens of each domain, sum of r * tokens * posterior, meet the targets. A step moves a
document's rate by the sum of its posteriors times the domains' errors relative to their sizes, cut off at 0.
The rate after k steps follows from the document's posterior and the k error vectors, so no rates
are stored between steps: each step is one aggregation, of a few numbers per task, over a settled
table of posteriors.

Null texts and texts without words have no tokens, the prior as posterior, and a rate like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.shared import settle

BUCKETS = 1024
# A text's evidence counts as so many words at most; else long texts would have posteriors of 0 and 1 only.
EVIDENCE_WORDS = 30.0
TOLERANCE, STEPS = 1e-4, 60
COPY_BITS = 30
# Documents of mixed posteriors add to domains that need no more; so the largest domain is lifted a little, too.
HEADROOM = 1.05


def words_of(text: str = "text") -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _array(values: list) -> Column:
    """A literal array of doubles, folded once into the plan."""
    return F.expr("array(" + ",".join(f"{v!r}D" for v in values) + ")")


def _summed(table: Column) -> Column:
    """Sum of a constant table's entries at the buckets of a text's words."""
    return F.aggregate("b", F.lit(0.0), lambda acc, x: acc + F.element_at(table, x + 1))


class DomainClassifier:
    """Log probabilities of hashed words in each domain, and the domains' prior."""

    def __init__(self, domains: list[str], prior: list[float], table: list[list[float]]):
        self.domains, self.prior, self.table = domains, prior, table


def learned(labelled: DataFrame) -> DomainClassifier:
    """From (text, domain): counts of ``BUCKETS`` word buckets per domain, so what comes to the driver is bounded."""
    known = labelled.where("domain IS NOT NULL")
    rows = known.select("domain", F.explode(F.transform(words_of(), _bucket)).alias("bucket")).groupBy("domain", "bucket").agg(F.count("*").alias("n")).collect()
    docs = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(docs)
    table = []
    for d in domains:
        counts = [0.5] * BUCKETS
        for r in rows:
            if r.domain == d:
                counts[r.bucket] += r.n
        total = sum(counts)
        table.append([round(math.log(c / total), 4) for c in counts])
    whole = sum(docs.values())
    return DomainClassifier(domains, [math.log(docs[d] / whole) for d in domains], table)


def posteriors(docs: DataFrame, model: DomainClassifier) -> DataFrame:
    """(doc_id, tokens, p0, p1, ...) of every document."""
    held = docs.select("doc_id", F.transform(words_of(), _bucket).alias("b"))
    counted = held.withColumn("tokens", F.size("b").cast("long"))
    weight = F.least(F.lit(EVIDENCE_WORDS), F.col("tokens").cast("double")) / F.greatest("tokens", F.lit(1))
    for k, values in enumerate(model.table):
        counted = counted.withColumn(f"l{k}", F.lit(model.prior[k]) + weight * _summed(_array(values)))
    names = [f"l{k}" for k in range(len(model.domains))]
    if not names:
        return counted.select("doc_id", "tokens")
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    raised = counted.withColumn("top", top).select("doc_id", "tokens", *(F.exp(F.col(n) - F.col("top")).alias(n) for n in names))
    whole = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return raised.select("doc_id", "tokens", *((F.col(n) / whole).alias(f"p{k}") for k, n in enumerate(names)))


def rate_after(errors: list[list[float]], domains: int) -> Column:
    """A document's rate after steps with these error vectors, from 1."""
    if not errors:
        return F.lit(1.0)
    history = F.array(*(_array(e) for e in errors))
    return F.aggregate(
        history, F.lit(1.0), lambda r, e: F.greatest(F.lit(0.0), r - sum((F.col(f"p{k}") * e[k] for k in range(1, domains)), F.col("p0") * e[0]))
    )


def least_targets(masses: list[float], weights: list[float]) -> list[float]:
    """Targets in the proportion of the weights, large enough that none is below its domain's mass and ``HEADROOM``."""
    most = HEADROOM * max((m / w for m, w in zip(masses, weights, strict=True) if w > 0), default=0.0)
    return [most * w for w in weights]


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, total: float | None = None) -> DataFrame:
    """Per document: doc_id, tokens, domain (likeliest), confidence (its posterior), rate, copies.

    ``labelled``: (text, domain). ``weights``: target share of each domain; the square roots of the
    domains' own shares if not given, which lifts small domains. ``total``: tokens wanted in all; by default so many that no
    domain has to be thinned out. ``copies`` is the rate rounded up or down by a hash of the id, so that it is the rate on average.
    """
    model = learned(labelled)
    n = len(model.domains)
    known = settle(posteriors(docs, model), "posteriors")
    if not n:
        return known.select("doc_id", "tokens", F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("confidence"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies"))

    def masses(rate: Column) -> list[float]:
        return [v or 0.0 for v in known.select(rate.alias("r"), "*").agg(*(F.sum(F.col("r") * F.col("tokens") * F.col(f"p{k}")) for k in range(n))).first()]

    own = masses(F.lit(1.0))
    shares = [weights.get(d, 0.0) for d in model.domains] if weights else [m**0.5 for m in own]
    scale = sum(shares) or 1.0
    shares = [s / scale for s in shares]
    targets = [total * s for s in shares] if total else least_targets(own, shares)
    errors: list[list[float]] = []
    now = own
    for _ in range(STEPS):
        gap = [(m - t) / max(o, 1.0) for m, t, o in zip(now, targets, own, strict=True)]
        if all(abs(m - t) <= TOLERANCE * max(t, 1.0) for m, t in zip(now, targets, strict=True)):
            break
        errors.append(gap)
        now = masses(rate_after(errors, n))
    best = F.greatest(*(F.struct(F.col(f"p{k}").alias("p"), F.lit(d).alias("d")) for k, d in enumerate(model.domains))) if n > 1 else F.struct(F.col("p0").alias("p"), F.lit(model.domains[0]).alias("d"))
    chance = F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(1 << COPY_BITS)) / float(1 << COPY_BITS)
    out = known.withColumn("rate", rate_after(errors, n)).withColumn("best", best)
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")
    return out.select("doc_id", "tokens", F.col("best.d").alias("domain"), F.col("best.p").alias("confidence"), "rate", copies.cast("int").alias("copies"))
