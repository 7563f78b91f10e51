"""Quality classifier by positive-unlabelled learning.

Each whole text becomes a few dozen figures (symbols, letter case, repetition, word and line lengths). A small
network minimises the non-negative unbiased risk: trusted positives against unlabelled texts, with the share of
good texts among all (class prior) estimated from the labelled training rows. Ids, labels, language and source are
not among the figures. Both samples are bounded and chosen by a hash; every document is scored.

Edge cases: null and empty texts have all figures 0 and get a score like any other. Without training positives
every score is the prior, 0.5 if nothing is labelled. Repeated rows score alike. Extra columns are ignored; labels
that repeat count once, by the largest ``quality``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.session import materialize

#: Rows of each sample that the model is fitted on.
POSITIVES, UNLABELLED = 6000, 12000
HIDDEN, STEPS, RATE = 24, 500, 0.02
FIGURES = 24


def figures(docs: DataFrame) -> DataFrame:
    """``doc_id, figures``: one pass over the texts."""

    def measure(batches: Iterator) -> Iterator:
        import re
        from collections import Counter
        from math import log, log1p

        import numpy as np
        import pandas as pd

        symbols, marks, letters = re.compile(r"[^\w\s.,;:'\"()?-]"), re.compile(r"[.,;:!?]"), re.compile(r"[^\W\d_]+")

        def of(text: str) -> list[float]:
            words = text.split()
            if not words:
                return [0.0] * FIGURES
            n, chars = len(words), sum(map(len, words))
            counts = Counter(words)
            top = sorted(counts.values(), reverse=True)
            lines = [x for x in text.split("\n") if x.strip()]
            pairs = Counter(zip(words, words[1:]))
            upper, odd = sum(w.isupper() and len(w) > 1 for w in words), symbols.findall(text)
            lone = sum(not letters.search(w) for w in words)
            tail = sum(not w[-1].isalnum() and w[-1] not in ".,;:?\"')" for w in words)
            runs = sum(a == b for a, b in zip(words, words[1:]))
            sentence = sum(w[-1] in ".?!" for w in words)
            lengths = [len(w) for w in words]
            return [
                log1p(n), log1p(chars), chars / n, min(len(odd) / chars, 1.0), upper / n, lone / n, tail / n, runs / n,
                top[0] / n, sum(top[:10]) / n, len(counts) / n, len(counts) / n**0.5, sum(c - 1 for c in pairs.values()) / n,
                len(lines) / n, 1 - len(set(lines)) / len(lines), sentence / n, len(marks.findall(text)) / chars,
                sum(c.isdigit() for c in text) / chars, sum(w[:1].isupper() for w in words) / n, max(lengths) / 20,
                float(np.std(lengths)) / 5, len(set(odd)) / 10, -sum(c / n * log(c / n) for c in top) / 10, log1p(n / len(lines)),
            ]

        for batch in batches:
            values = [np.array(of(t or ""), "float32") for t in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id.astype("Int64"), "figures": values})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(measure, "doc_id bigint, figures array<float>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(positive, unlabelled, prior: float):
    """Network weights that minimise the non-negative risk; all rows in every step, Adam with fixed steps."""
    import numpy as np

    both = np.vstack([positive, unlabelled])
    middle, spread = both.mean(0), both.std(0) + 1e-6
    p, u = (np.clip((x - middle) / spread, -6, 6) for x in (positive, unlabelled))
    random = np.random.default_rng(0)
    w1, b1 = random.normal(0, 1 / p.shape[1] ** 0.5, (p.shape[1], HIDDEN)), np.zeros(HIDDEN)
    w2, b2 = random.normal(0, 1 / HIDDEN**0.5, HIDDEN), np.zeros(1)
    theta, first, second = [w1, b1, w2, b2], [np.zeros_like(x) for x in (w1, b1, w2, b2)], [np.zeros_like(x) for x in (w1, b1, w2, b2)]

    def forward(x):
        hidden = np.tanh(x @ theta[0] + theta[1])
        return hidden, 1 / (1 + np.exp(-(hidden @ theta[2] + theta[3])))

    def backward(x, hidden, slope):
        inner = np.outer(slope, theta[2]) * (1 - hidden**2)
        return [x.T @ inner, inner.sum(0), hidden.T @ slope, np.array([slope.sum()])]

    for step in range(1, STEPS + 1):
        (hp, sp), (hu, su) = forward(p), forward(u)
        # Sigmoid loss: a positive costs 1 - s, a negative s.
        negative = su.mean() - prior * sp.mean()
        dp, du = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        if negative >= 0:
            slope_p, slope_u = -2 * prior * dp, du
        else:  # the risk of the negatives is below zero, so only that is undone
            slope_p, slope_u = prior * dp, -du
        grads = [a + b for a, b in zip(backward(p, hp, slope_p), backward(u, hu, slope_u))]
        for i, g in enumerate(grads):
            g = g + 1e-4 * theta[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            theta[i] = theta[i] - RATE * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return middle, spread, theta


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    measured = materialize(figures(docs), "quality-figures")
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.filter(~held_out(F.col("doc_id")))
    shares = known.agg(F.count("*").alias("n"), F.sum((F.col("quality") == 1).cast("int")).alias("good")).first()
    n, good = shares.n, shares.good or 0
    prior = min((good + 1) / (n + 2), 0.99)

    def below(rows: DataFrame, most: int, among: int) -> DataFrame:
        """About twice ``most`` of ``among`` rows, by the hash that the sample is ordered by: few rows leave a task."""
        share = min(1.0, 2 * most / max(among, 1))
        return rows.filter(F.xxhash64("doc_id") <= F.lit(min(2**63 - 1, int(share * 2**64) - 2**63)))

    def sample(rows: DataFrame, most: int):
        import numpy as np

        # Bounded by ``most``, and with ``below`` nearly so over all tasks together.
        taken = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "figures").limit(most).select("figures").toPandas().figures
        return np.stack(taken).astype("float64") if len(taken) else np.empty((0, FIGURES))

    trusted = below(known.filter("quality = 1").select("doc_id"), POSITIVES, good)
    positive = sample(below(measured, POSITIVES, good).join(trusted, "doc_id", "left_semi"), POSITIVES)
    unlabelled = sample(below(measured, UNLABELLED, measured.count()), UNLABELLED)
    model = fit(positive, unlabelled, prior) if len(positive) else None

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for batch in batches:
            if not len(batch):
                continue
            if model is None:
                scores = np.full(len(batch), prior)
            else:
                middle, spread, (w1, b1, w2, b2) = model
                x = np.clip((np.stack(batch.figures) - middle) / spread, -6, 6)
                scores = 1 / (1 + np.exp(-(np.tanh(x @ w1 + b1) @ w2 + b2)))
            yield pd.DataFrame({"doc_id": batch.doc_id.astype("Int64"), "score": scores})

    scored = measured.mapInPandas(score, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
