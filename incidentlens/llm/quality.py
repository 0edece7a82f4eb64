"""Quality rules: hashed n-gram log-likelihood ratio between trusted text and the raw corpus.

DataFrame functions only. Words and word pairs are hashed into ``BUCKETS`` cells; the trusted
multinomial counts them over labelled good documents, the raw multinomial over every document.
A document's verdict is the mean log ratio of its n-grams against a threshold fitted on the
labelled documents; the base rules (word count, repeated windows) come first.

Defined results: a NULL, empty or white-space text has no words, fails the base rule and is not
kept; repeated rows are judged alike; an empty table gives an empty result; without labels of
both kinds the threshold is minus infinity, so only the base rules decide; input columns named
like an output are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, without

#: Cells of the hashed multinomials: two tables of this many counts reach the driver, whatever the corpus.
BUCKETS = 1 << 15
#: At most this many labelled documents (smallest hash of the id first) train the target and the threshold.
MAX_LABELLED = 20_000
#: Words that stand for a document's style count in all of it: pairs and single words weigh the same.
SMOOTHING = 0.5
#: Share of trusted documents that the threshold may reject at most.
MAX_LOSS = 0.002
MIN_WORDS = 20
WINDOW = 8
OUTPUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")

_SPACES = "' \\t\\n\\u000B\\u000C\\r'"


def words_of(text: str) -> Column:
    """Array of the words of a text column (empty for NULL)."""
    trimmed = f"trim(BOTH {_SPACES} FROM coalesce({text}, ''))"
    return F.expr(f"if({trimmed} = '', cast(array() as array<string>), split({trimmed}, '[ \\\\t-\\\\r]+'))")


def with_words(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_w", words_of("text"))


def ngram_cells(words: str = "_w") -> Column:
    """Cells of all single words, then of all word pairs."""
    single = f"transform({words}, x -> cast(pmod(xxhash64(x), {BUCKETS}) as int))"
    pairs = (f"zip_with(slice({words}, 1, size({words}) - 1), slice({words}, 2, size({words}) - 1), "
             f"(a, b) -> cast(pmod(xxhash64(a, b), {BUCKETS}) as int))")
    return F.expr(f"if(size({words}) < 2, {single}, concat({single}, {pairs}))")


def with_repeat_words(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``_w``) plus ``n_repeat_words``: words that lie in a window of 8 words occurring
    twice or more in the text.

    Hashes of 1, 2, 4 and 8 words double in the row; only texts with an equal pair of windows sort
    theirs to find the places, and count each covered word once."""
    docs = docs.withColumn("_h8", F.expr("transform(_w, x -> xxhash64(x))"))
    for width in (1, 2, 4):
        left = f"greatest(size(_h8) - {width}, 0)"
        docs = docs.withColumn("_h8", F.expr(f"zip_with(slice(_h8, 1, {left}), slice(_h8, {1 + width}, {left}), "
                                             "(a, b) -> xxhash64(a, b))"))
    covered = f"""
      transform(array(array_sort(transform(_h8, (v, i) -> struct(v, i)))), s ->
        transform(array(array_sort(filter(transform(s, (e, k) -> if(
            (k > 0 and s[greatest(k - 1, 0)].v = e.v) or (k < size(s) - 1 and s[least(k + 1, size(s) - 1)].v = e.v),
            e.i, -1)), p -> p >= 0))), p ->
          aggregate(transform(p, (at, k) -> if(k = size(p) - 1, {WINDOW}, least({WINDOW}, p[least(k + 1, size(p) - 1)] - at))),
                    0L, (a, b) -> a + b))[0])[0]"""
    return docs.withColumn("n_repeat_words", F.expr(
        f"if(size(array_distinct(_h8)) = size(_h8), 0L, {covered})")).drop("_h8")


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``_w``) plus the base columns."""
    chars = f"coalesce(text, '')"
    return (docs
            .withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.expr(f"length(translate({chars}, {_SPACES}, ''))").cast("long"))
            .withColumn("n_symbols", F.expr(f"length({chars}) - length(translate({chars}, '#*$%&|<>', ''))").cast("long"))
            .withColumn("_lines", F.expr(f"filter(split({chars}, '\\n'), l -> l rlike '[^ \\\\t-\\\\r]')"))
            .withColumn("n_dup_lines", F.expr("size(_lines) - size(array_distinct(_lines))").cast("long"))
            .transform(with_repeat_words)
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))
            .drop("_lines"))


def labelled_sample(labels: DataFrame) -> DataFrame:
    """At most MAX_LABELLED rows (id, good): bounded, so it is broadcast."""
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg((F.min("quality") == 1).alias("_good"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("_toxic"))
             .where("not _good or _toxic = 0").drop("_toxic"))  # toxic but well written: neither target nor junk
    return known.withColumnRenamed("doc_id", "_label_id").orderBy(F.xxhash64("_label_id")).limit(MAX_LABELLED)


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log(trusted / raw) of each cell; raw over all documents, trusted over the labelled good ones."""
    marked = docs.select("doc_id", "text").join(F.broadcast(labels), F.col("doc_id") == F.col("_label_id"), "left")
    cells = with_words(marked).select(F.coalesce("_good", F.lit(False)).cast("int").alias("good"),
                                      F.explode(ngram_cells()).alias("cell"))
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.sum("good").alias("g")).collect():
        raw[r["cell"]], good[r["cell"]] = r["n"], r["g"]
    if not good.sum():
        return np.zeros(BUCKETS)
    share = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)
    return np.log(share(good)) - np.log(share(raw))


def with_score(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``docs`` (with ``_w``) plus ``score``, the mean log ratio of the n-grams (NULL without words)."""
    weights = F.split(F.lit(",".join(f"{x:.4f}" for x in ratios)), ",").cast("array<double>")
    cells = docs.withColumn("_cells", ngram_cells())
    total = F.aggregate("_cells", F.lit(0.0), lambda a, c: a + F.get(weights, c))
    return cells.withColumn("score", F.when(F.size("_cells") > 0, total / F.size("_cells"))).drop("_cells")


def fit_threshold(scores: list[tuple[float, bool]]) -> float:
    """The cut with the most labelled documents on their right side, losing at most MAX_LOSS of the good."""
    good = np.sort([s for s, g in scores if g])
    bad = np.sort([s for s, g in scores if not g])
    if not len(good) or not len(bad):
        return -math.inf
    cuts = np.concatenate([[-math.inf], (np.concatenate([good, bad]))])
    lost = np.searchsorted(good, cuts)  # good documents under the cut
    right = np.searchsorted(bad, cuts) / len(bad) - lost / len(good)
    right[lost > MAX_LOSS * len(good)] = -math.inf
    best = cuts[int(np.argmax(right))]
    under = bad[bad < best]
    return float((under[-1] + best) / 2) if len(under) else float(best)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, ...) with the base columns, ``score`` and ``kept``."""
    docs = without(docs, *OUTPUT)
    sample = labelled_sample(labels)
    ratios = log_ratios(docs, sample)
    seen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_label_id"))
    scored = with_score(with_words(seen), ratios).select("score", "_good")  # a filter here would move below the join
    cut = fit_threshold([(r["score"], r["_good"]) for r in scored.collect() if r["score"] is not None])
    out = with_score(base_rules(with_words(docs)), ratios)
    passed = F.lit(True) if math.isinf(cut) else F.coalesce(F.col("score") >= F.lit(cut), F.lit(False))
    out = out.withColumn("kept", ~F.col("base_failed") & passed)
    # one row's verdict as one generated row: a filter on ``kept`` then stays above, and is not copied
    # with the whole chain of array functions into a scan of its own
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(F.array(F.struct(*OUTPUT))))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "score", "kept")
