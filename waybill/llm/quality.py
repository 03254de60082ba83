"""Quality rules and a log-likelihood ratio, by DataFrame operations only.

Base statistics are taken from every whole text. Beyond them, a document is
scored by how much better its n-grams fit a trusted corpus than the raw one:
words and marks, and pairs of neighbours, are hashed into a fixed number of
buckets, whose counts over the trusted documents and over all documents give
two multinomials with one added to each count. The score is the mean, over the
document's n-grams, of the logarithm of the two probabilities' ratio, and the
document is kept if it reaches a fixed threshold; nothing is drawn at random.

Counts of the raw corpus cover all documents. The trusted ones are a bounded
sample of those labelled good: the first ``TRUSTED_DOCUMENTS`` by a hash of
their id. Without a trusted document the ratio says nothing, and the base
rules alone decide. NULL texts have no words and fail.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.shared import SPACE_CHARACTERS, WORD, free_name

#: Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
SYMBOLS = r"[#*$%&|<>]"

BUCKETS = 1 << 14
TRUSTED_DOCUMENTS = 20_000
#: Documents below this mean log ratio go. Text like the trusted one has about zero.
LEAST_SCORE = -0.25

#: Words and marks; case is kept, as shouting is a sign of its own.
_GRAM = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"


def _once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """``frame`` with a column that is computed once per row.

    A projection would be merged into the next one, and an array that a lambda
    refers to would be built anew for every element. Nothing merges through a
    generator.
    """
    return frame.withColumn(name, F.explode(F.array(value)))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    The words of a repeated window are found by sorting: a window's hash and
    its position are put into one number, so equal windows become neighbours.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.expr(f"regexp_extract_all(q_text, '{WORD}', 0)".replace("\\", "\\\\"))
    lines = F.filter(
        F.split(F.col("q_text"), "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARACTERS)) != ""
    )
    q = _once(docs, "q_text", whole)
    q = _once(q, "q_words", words)
    q = q.withColumns(
        {
            "n_words": F.size("q_words").cast("long"),
            "word_chars": F.length(F.array_join("q_words", "")).cast("long"),
            "n_symbols": F.regexp_count("q_text", F.lit(SYMBOLS)).cast("long"),
        }
    )
    q = _once(q, "q_lines", lines)
    q = _once(q, "q_hashes", F.transform("q_words", lambda word: F.xxhash64(word))).drop("q_words")
    windows = F.when(
        F.size("q_hashes") >= 3,
        F.expr(
            "transform(slice(q_hashes, 1, size(q_hashes) - 2),"
            " (h, i) -> xxhash64(h, q_hashes[i + 1], q_hashes[i + 2]))"
        ),
    ).otherwise(F.array().cast("array<long>"))
    q = _once(q, "q_windows", windows).drop("q_hashes")
    q = q.withColumns(
        {
            "n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
            # As many low bits as positions need.
            "q_mask": F.expr("shiftleft(1L, length(bin(size(q_windows)))) - 1"),
            "q_shift": F.expr("length(bin(size(q_windows)))"),
        }
    )
    numbered = F.when(
        F.size(F.array_distinct("q_windows")) < F.size("q_windows"),
        F.expr("sort_array(transform(q_windows, (h, i) -> (h & ~q_mask) | i))"),
    ).otherwise(F.array().cast("array<long>"))
    q = _once(q, "q_numbered", numbered)
    repeated = F.expr(
        """sort_array(transform(filter(q_numbered, (k, i) ->
             (i > 0 AND (k & ~q_mask) = (q_numbered[greatest(i - 1, 0)] & ~q_mask)
               AND q_windows[int(k & q_mask)]
                 = q_windows[int(q_numbered[greatest(i - 1, 0)] & q_mask)])
             OR (i < size(q_numbered) - 1
               AND (k & ~q_mask) = (q_numbered[least(i + 1, size(q_numbered) - 1)] & ~q_mask)
               AND q_windows[int(k & q_mask)]
                 = q_windows[int(q_numbered[least(i + 1, size(q_numbered) - 1)] & q_mask)])),
           k -> int(k & q_mask)))"""
    )
    q = _once(q, "q_repeated", repeated)
    covered = F.expr(
        """aggregate(transform(q_repeated, (p, i) ->
             least(3, coalesce(get(q_repeated, i + 1), p + 3) - p)), 0L, (s, x) -> s + x)"""
    )
    q = _once(q, "n_repeat_words", covered)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return q.withColumn("base_failed", failed).drop(
        "q_text", "q_lines", "q_windows", "q_mask", "q_shift", "q_numbered", "q_repeated"
    )


def _with_tokens(frame: DataFrame, text: str) -> DataFrame:
    """``frame`` with q_tokens, the hashes of a text's words and marks."""
    found = F.expr(f"regexp_extract_all({text}, '{_GRAM}', 0)".replace("\\", "\\\\"))
    cut = _once(frame, "q_cut", F.coalesce(found, F.array().cast("array<string>")))
    hashed = F.transform("q_cut", lambda token: F.xxhash64(token))
    return _once(cut, "q_tokens", hashed).drop("q_cut")


def _grams() -> Column:
    """The buckets of all tokens of q_tokens and of all pairs of neighbours, the first with itself."""
    return F.expr(
        f"""concat(transform(q_tokens, h -> int(h & {BUCKETS - 1})),
              transform(q_tokens, (h, i) -> int(
                (shiftleft(q_tokens[greatest(i - 1, 0)], 1) ^ h) & {BUCKETS - 1})))"""
    )


def trusted_documents(labels: DataFrame, most: int = TRUSTED_DOCUMENTS) -> DataFrame:
    """Ids of documents labelled good; at most ``most``, whatever the number of labels."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def log_ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """The logarithm of trusted over raw probability of every bucket; [] without trusted ones.

    ``trusted`` is bounded (see ``trusted_documents``), so it is broadcast.
    What comes back to the driver is a row per bucket.
    """
    marked = trusted.select(F.col("doc_id").alias("q_trusted"))
    texts = docs.select(F.col("doc_id").alias("q_id"), F.col("text").alias("q_text"))
    joined = texts.join(F.broadcast(marked), F.col("q_id") == F.col("q_trusted"), "left")
    flagged = joined.select("q_text", F.col("q_trusted").isNotNull().cast("long").alias("q_good"))
    grams = _with_tokens(flagged, "q_text").select("q_good", F.explode(_grams()).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("q_good").alias("good"))
    raw, good = [1] * BUCKETS, [1] * BUCKETS
    for row in counts.collect():
        raw[row["bucket"]] += row["raw"]
        good[row["bucket"]] += row["good"]
    if sum(good) == BUCKETS:
        return []
    base = math.log(sum(raw)) - math.log(sum(good))
    return [math.log(g) - math.log(r) + base for g, r in zip(good, raw)]


def with_score(docs: DataFrame, ratios: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the mean log ratio of a text's n-grams, 0.0 for none."""
    if not ratios:
        return docs.withColumn("score", F.lit(0.0))
    # A constant array, which Spark folds once; it has a number per bucket.
    listed = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    total = F.aggregate(_grams(), F.lit(0.0), lambda sum_, bucket: sum_ + F.get(listed, bucket))
    tokens = F.size("q_tokens")
    mean = F.when(tokens > 0, total / (2 * tokens)).otherwise(0.0)
    return _with_tokens(docs, text).withColumn("score", mean).drop("q_tokens")


def judge(docs: DataFrame, labels: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """doc_id, the base statistics, base_failed, score and kept of every document."""
    ratios = log_ratios(docs, trusted_documents(labels))
    texts = docs.select("doc_id", "text")
    scored = with_score(with_base(texts), ratios)
    kept = ~F.col("base_failed") & (F.col("score") >= least_score)
    return scored.withColumn("kept", kept).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "score",
        "kept",
    )


def kept_documents(docs: DataFrame, labels: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    ratios = log_ratios(docs, trusted_documents(labels))
    row = free_name(docs, "q_row")
    whole = docs.select("text", F.struct(*map(F.col, docs.columns)).alias(row))
    scored = with_score(with_base(whole), ratios)
    kept = scored.filter(~F.col("base_failed") & (F.col("score") >= least_score))
    return kept.select(*(F.col(row).getField(name).alias(name) for name in docs.columns))
