"""Quality rules with a hashed n-gram log-likelihood ratio.

Tokens (letter and digit runs, and runs of other printable characters) and pairs of neighbouring tokens are
hashed into ``buckets`` counters. Two multinomials with add-one smoothing come from them: the raw one from every
document, the target one from every trusted document. A document's score is the mean log ratio of its n-grams; it is
kept if the score reaches ``threshold`` and no base rule fails. Every document is decided, none by chance.

Edge cases: a null or blank text has no words, fails the base rule and scores 0. Without trusted documents every
score is 0, so the base rules decide alone. Repeated rows are decided alike. Extra columns pass through; result
columns take the place of input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.llm.common import fresh, words
from candlespark.session import materialize

TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
SYMBOLS = "#*$%&|<>"
BUCKETS = 16384
THRESHOLD = -0.25
WINDOW = 5
#: The ids' bitmap has 2 ** FILTER_BITS bits.
FILTER_BITS = 20


def grams(text: Column, buckets: int = BUCKETS) -> tuple[Column, Column]:
    """Buckets of the tokens and of the token pairs, given a column of tokens."""
    single = F.transform(text, lambda t: F.pmod(F.hash(t), F.lit(buckets)))
    pairs = F.zip_with(text, F.slice(text, F.lit(2), F.greatest(F.size(text), F.lit(1))), lambda a, b: F.pmod(F.hash(a, b), F.lit(buckets)))
    return single, pairs


def with_grams(df: DataFrame, text: Column, name: str, buckets: int) -> DataFrame:
    tokens = fresh(df, "tokens")
    df = df.withColumn(tokens, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 0))
    return df.withColumn(name, F.concat(*grams(F.col(tokens), buckets))).drop(tokens)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Distinct ids of all documents labelled good."""
    return labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def id_filter(ids: DataFrame, bits: int = FILTER_BITS) -> Column:
    """A test on ``doc_id`` that all of ``ids`` pass, and others by chance: a bitmap of fixed size, whatever the number of ids."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    words = ids.groupBy(F.shiftright(place(F.col("doc_id")), 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {1 << bits}L) & 63 AS int))")).alias("set")
    )
    known = [0] * (1 << (bits - 6))
    for row in words.collect():
        known[row.word] = row.set
    bitmap = F.split(F.lit(",".join(map(str, known))), ",").cast("array<bigint>")
    word = F.get(bitmap, F.shiftright(place(F.col("doc_id")), 6).cast("int"))
    return F.getbit(word, place(F.col("doc_id")).bitwiseAND(F.lit(63)).cast("int")) == 1


def fit_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Log ratio of each bucket, counted over all documents and all trusted ones; only ``buckets`` rows reach the driver.

    Texts that cannot be trusted by ``id_filter`` are counted where they are read. The others meet the ids in a shuffle, by one
    plan at every size.
    """
    ids = materialize(trusted_ids(labels), "trusted-ids")
    maybe = F.col("doc_id").isNotNull() & id_filter(ids)
    texts = docs.select("doc_id", "text")
    met = texts.where(maybe).join(ids.withColumn("trusted", F.lit(1)).hint("merge"), "doc_id", "left")
    flagged = met.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), "text").unionByName(texts.where(~maybe).select(F.lit(0).alias("trusted"), "text"))
    counted = (
        with_grams(flagged, F.col("text"), "grams", buckets)
        .select("trusted", F.explode("grams").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
        .collect()
    )
    raw, target = [1] * buckets, [1] * buckets
    for row in counted:
        raw[row.bucket] += row.raw
        target[row.bucket] += row.target
    if sum(target) == buckets:
        return [0.0] * buckets
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [round(math.log(t) - math.log(r) + shift, 6) for t, r in zip(target, raw)]


def ratio_score(grams_column: Column, weights: list[float]) -> Column:
    """Mean weight of the buckets; 0 without any."""
    # A foldable text literal: the optimiser turns it into one array that all rows share.
    known = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(grams_column, F.lit(0.0), lambda total, b: total + F.get(known, b))
    return F.when(F.size(grams_column) > 0, total / F.size(grams_column)).otherwise(F.lit(0.0))


def _repeat_layers(df: DataFrame, text_words: str, name: str) -> DataFrame:
    """Number of words inside windows of ``WINDOW`` words that occur twice or more in the text.

    Equal windows meet in a sorted array of hashes; only texts with a repeated window take the longer way.
    """
    w = F.col(text_words)
    h, s, z = (fresh(df, f"{name}_{x}") for x in "hsz")
    starts = F.size(w) - WINDOW + 1
    hashes = F.transform(F.sequence(F.lit(0), starts - 1), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    df = df.withColumn(h, F.when(starts > 0, hashes).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    after = F.slice(F.col(s), F.lit(2), F.greatest(F.size(s), F.lit(1)))
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.col(s))
    met = F.filter(
        F.arrays_zip(F.col(s).alias("own"), after.alias("next"), before.alias("last")),
        lambda x: F.coalesce(x["own"]["h"] == x["next"]["h"], F.lit(False)) | F.coalesce(x["own"]["h"] == x["last"]["h"], F.lit(False)),
    )
    df = df.withColumn(z, F.sort_array(F.transform(met, lambda x: x["own"]["i"])))
    following = F.concat(F.slice(F.col(z), F.lit(2), F.greatest(F.size(z), F.lit(1))), F.array(F.lit(2**31 - 1)))
    covered = F.zip_with(F.col(z), following, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    counted = F.aggregate(covered, F.lit(0).cast("bigint"), lambda t, x: t + F.coalesce(x, F.lit(0)))
    return df.withColumn(name, F.when(F.size(z) > 0, counted).otherwise(F.lit(0).cast("bigint"))).drop(h, s, z)


def base_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    own = fresh(df, "words")
    body = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn(own, words(F.col(text)))
    df = _repeat_layers(df, own, "n_repeat_words")
    lines = fresh(df, "lines")
    df = df.withColumn(lines, F.filter(F.split(body, "\n"), lambda x: F.ltrim(F.translate(x, "\t\x0b\x0c\r", "    ")) != ""))
    df = df.withColumns(
        {
            "n_words": F.size(own).cast("bigint"),
            "word_chars": F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("bigint"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        }
    ).drop(own, lines)
    return df.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def judge(docs: DataFrame, weights: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """Adds the base figures, ``score`` and ``kept`` to every document."""
    scored = fresh(docs, "grams")
    df = with_grams(docs, F.col("text"), scored, len(weights))
    df = df.withColumn("score", ratio_score(F.col(scored), weights)).drop(scored)
    df = base_rules(df)
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they had."""
    weights = fit_weights(docs, labels)
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("packed_row"))
    # A generator, not a filter: a filter would be pushed down with all its expressions and compute them again per use.
    return judge(packed, weights).select(F.inline(F.filter(F.array("packed_row"), lambda _: F.col("kept"))))
