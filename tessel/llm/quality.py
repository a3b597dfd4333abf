"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame functions only.

Rules on the whole text: its number of words, symbols, repeated lines and words inside
repeated eight-word windows.  The method: every word, and every word with the next one
(the last with an end), falls into one of ``BUCKETS`` by hash; the trusted-target
multinomial (documents that ``labels`` mark as good) and the raw-corpus multinomial (all
documents) are counted over these buckets with one added to each, and a document's score is the
mean log ratio of its n-grams.  Ratios are rounded to millionths, so a score is an exact
sum whatever the order.  A document is kept at or over a threshold that every document is
held against: the highest (in thousandths) that ``KEEP`` of the trusted documents that pass
the rules reach.  Nothing is sampled.

Two passes over the texts: one explodes n-grams into bucket counts, combined in each task
before the shuffle (``BUCKETS`` rows come back), one scores row by row.  Trusted ids are
broadcast where a count finds at most ``BROADCAST_IDS`` of them; beyond that the join is
left to Spark.

Defined cases: a null or empty text has no words, score 0 and fails the rules; repeated
rows are judged each; rows without an id are never trusted; of an id with several labels
all must be good; without trusted documents every document that passes the rules stays; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.session import materialize

BUCKETS = 1 << 16
WINDOW = 8
MIN_WORDS = 20
REPEATED = 30  # percent of the words
SYMBOLS = "#*$%&|<>"
KEEP = 0.995  # share of the trusted documents the threshold lets pass
BROADCAST_IDS = 1_000_000
MICRO = 1_000_000
_SPACE = " \t\n\x0b\x0c\r"


def _hashed(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id``, ``more``, ``word_chars``, ``_h`` (the hashes of the words) and ``_h2`` (of each with the next,
    the last alone)."""
    found = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", *more, found.alias("_words"))
    chars = F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w))
    hashes = F.transform("_words", lambda w: F.xxhash64(w))
    rows = rows.select("*", chars.alias("word_chars"), hashes.alias("_h")).drop("_words")
    return rows.select("*", _doubled(F.col("_h"), 1).alias("_h2"))


def _doubled(hashes: Column, apart: int) -> Column:
    """Hash of each value with the one ``apart`` places on; ``apart`` also tells the lengths apart."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + apart), F.lit(apart)))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def _covered(windows: Column) -> Column:
    """Words under windows that stand twice: the places of such windows ascending, each covers what
    the one before leaves."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    beside = lambda a, x, i: F.coalesce(F.get(a, i)["h"] == x["h"], F.lit(False))
    twice = F.aggregate(
        F.array(placed),
        F.array().cast("array<int>"),
        lambda _, a: F.transform(F.filter(a, lambda x, i: beside(a, x, i - 1) | beside(a, x, i + 1)), lambda x: x["i"]),
    )
    state = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    added = F.aggregate(
        F.sort_array(twice),
        state,
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n")),
    )
    return added["n"]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id``, the columns of the rules, and the hashes ``_h`` and ``_h2``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # an aggregate over an array of one array names that array, so it is made once
    repeats = F.aggregate(F.array(lines), F.lit(0), lambda _, x: F.size(x) - F.size(F.array_distinct(x)))
    symbols = F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))
    rows = _hashed(docs, symbols.cast("long").alias("n_symbols"), repeats.cast("long").alias("n_dup_lines"))
    rows = rows.withColumn("_h4", _doubled(F.col("_h2"), 2))
    # without the same four words twice there are no eight
    again = lambda a: F.size(F.array_distinct(a)) < F.size(a)
    four = F.slice("_h4", 1, F.greatest(F.size("_h4") - 3, F.lit(0)))
    eight = F.slice(_doubled(F.col("_h4"), 4), 1, F.greatest(F.size("_h4") - (WINDOW - 1), F.lit(0)))
    none = F.lit(0).cast("long")
    covered = F.aggregate(F.array(eight), none, lambda n, a: F.when(again(a), _covered(a)).otherwise(n))
    repeated = F.when(again(four), covered).otherwise(none)
    return rows.select(
        "doc_id",
        F.size("_h").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated.alias("n_repeat_words"),
        "_h",
        "_h2",
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that all their labels call good, one row each."""
    good = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"))
    ids, _ = materialize(good.filter("q = 1").select(F.col("doc_id").alias("trusted_id")), "trusted")
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Millionths of the log ratio of target to raw probability, for every bucket."""
    rows = _hashed(docs)
    rows = rows.join(trusted, rows["doc_id"] == trusted["trusted_id"], "left")
    grams = rows.select(F.col("trusted_id").isNotNull().cast("long").alias("t"), F.explode(F.concat("_h", "_h2")).alias("h"))
    grams = grams.select("t", _bucket(F.col("h"), buckets).alias("b"))
    counts = grams.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target")).collect()  # at most `buckets` rows
    raw, target = [0] * buckets, [0] * buckets
    for r in counts:
        raw[r["b"]], target[r["b"]] = r["raw"], r["target"]
    if not sum(target):
        return [0] * buckets
    every = math.log((sum(raw) + buckets) / (sum(target) + buckets))
    return [round(MICRO * (math.log((t + 1) / (r + 1)) + every)) for t, r in zip(target, raw)]


def score(docs: DataFrame, ratios: list[int]) -> DataFrame:
    """The columns of the rules, ``base_failed`` and ``score``, one row for each of ``docs``."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<bigint>")  # one folded literal
    summed = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, h: s + F.get(table, _bucket(h, len(ratios))))
    total = summed("_h") + summed("_h2")
    mean = total / (F.lit(2.0 * MICRO) * F.greatest(F.col("n_words"), F.lit(1)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return features(docs).select("*", failed.alias("base_failed"), mean.alias("score")).drop("_h", "_h2")


def threshold(scored: DataFrame, trusted: DataFrame, keep: float = KEEP) -> float | None:
    """The highest thousandth that ``keep`` of the trusted documents passing the rules reach; none without any."""
    mine = scored.filter("NOT base_failed").join(trusted, scored["doc_id"] == trusted["trusted_id"])
    step = F.greatest(F.least(F.floor(1000 * F.col("score")), F.lit(50_000)), F.lit(-50_000))
    counts = sorted((r["k"], r["n"]) for r in mine.groupBy(step.alias("k")).agg(F.count("*").alias("n")).collect())
    left = total = sum(n for _, n in counts)
    best = None
    for k, n in counts:
        if left < keep * total:
            break
        best, left = k, left - n
    return None if best is None else best / 1000


def quality(docs: DataFrame, labels: DataFrame, keep: float = KEEP, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept``."""
    trusted = trusted_ids(labels)
    scored, _ = materialize(score(docs, log_ratios(docs, trusted, buckets)), "quality")
    least = threshold(scored, trusted, keep)
    good = F.lit(True) if least is None else F.col("score") >= least
    return scored.withColumn("kept", ~F.col("base_failed") & good)
