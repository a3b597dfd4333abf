"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence gets a probability from a
hashed bag of words, ``p = sigmoid(b + sum w)``, and the document's score is the
noisy-or ``1 - prod(1 - p)``: it is toxic when at least one sentence is.  The
weights are fitted from document labels alone (gradient of the noisy-or
likelihood), after which the sentence probabilities locate the offending spans.

Fitting uses at most ``FIT_DOCUMENTS`` labelled documents, the ones with the
smallest hash of their id, whatever the size of the tables; scoring is one
``mapInArrow`` pass over all documents with no shuffle.

Defined cases: a null or empty text has no sentences and scores as one empty
sentence (the bias alone); labels with a null id or null ``toxic`` teach
nothing, several labels of one id count as toxic if any is; with no labels, or
labels of one kind only, the model is the constant prior; repeated rows are
scored each; columns besides ``doc_id`` and ``text`` are never read as inputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.plans.indexing import unused
from tessel.llm.words import alnum_separator_table, chunks, crc_remainder, mix, text_buffer, words

FIT_DOCUMENTS = 5000  # documented bound on the labelled documents the classifier is fitted on
FEATURES = 1 << 18
PREFIXES = (4, 5)  # bytes of a word's beginning that count as a feature too
MIN_DOCUMENTS = 4  # documents a feature must occur in to get a weight of its own
STEPS = 300
L1_DOCUMENTS = 3.0  # documents that must pull on a feature before its weight leaves zero
THRESHOLD = 0.7
SPAN_THRESHOLD = 0.5

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """Features of every sentence of a batch of texts.

    Returns ``(feature of each word, sentence of each word, document of each sentence,
    byte span of each sentence)``; a word counts once a sentence.
    """
    h, start, end, first = words(data, offsets, alnum_separator_table())
    if not len(h):
        none = np.zeros(0, np.int64)
        return none, none, none, (none, none)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    breaks = np.cumsum(_ENDS[data], dtype=np.int64)[start]
    new = np.ones(len(h), bool)
    new[1:] = (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])
    sentence = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(h)) - 1
    seen = [sentence * FEATURES + (h % np.uint64(FEATURES)).astype(np.int64)]
    for k in PREFIXES:  # word stems, for inflected words
        stem = mix(words(data, offsets, alnum_separator_table(), prefix=k)[0][end - start >= k], k)
        seen.append(sentence[end - start >= k] * FEATURES + (stem % np.uint64(FEATURES)).astype(np.int64))
    once = np.unique(np.concatenate(seen))
    return once % FEATURES, once // FEATURES, doc[at], (start[at], end[last])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def sentence_scores(weights: np.ndarray, bias: float, feature, sentence, n: int) -> np.ndarray:
    return _sigmoid(bias + np.bincount(sentence, weights[feature], minlength=n))


def noisy_or(p: np.ndarray, doc: np.ndarray, n: int, empty: float) -> np.ndarray:
    """``1 - prod(1 - p)`` for each of ``n`` documents; ``empty`` for those without sentences."""
    clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)
    return np.where(np.bincount(doc, minlength=n) == 0, empty, -np.expm1(clean))


def fit_rows(feature, sentence, doc, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Noisy-or likelihood by Adam; ``doc`` maps sentences to rows of ``label``."""
    n_docs, n = len(label), len(doc)
    weights, prior = np.zeros(FEATURES), float(np.clip(label.mean() if n_docs else 0.0, 1e-3, 1 - 1e-3))
    bias = float(np.log(prior / (1 - prior)))
    if n == 0 or label.min() == label.max():
        return weights, min(bias, -3.0)
    seen = np.unique(doc[sentence] * FEATURES + feature)  # each feature once a document
    df = np.bincount(seen % FEATURES, minlength=FEATURES)
    toxic_df = np.bincount((seen % FEATURES)[label[seen // FEATURES] > 0], minlength=FEATURES)
    del seen  # as long as the sample's words
    used = np.flatnonzero(df >= MIN_DOCUMENTS)
    column = np.full(FEATURES, -1)
    column[used] = np.arange(len(used))
    keep = column[feature] >= 0
    f, s = column[feature[keep]], sentence[keep]
    # start from the smoothed log odds of the features that speak for the label
    clean_df = df[used] - toxic_df[used]
    odds = np.log((toxic_df[used] + 0.5) / (label.sum() + 1)) - np.log((clean_df + 0.5) / (n_docs - label.sum() + 1))
    w, b = np.where(toxic_df[used] >= 2 * L1_DOCUMENTS, np.maximum(odds - 1, 0), 0.0), -6.0
    l1, rate = L1_DOCUMENTS / n_docs, 0.08
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = _sigmoid(b + np.bincount(s, w[f], minlength=n))
        clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n_docs)
        total = np.clip(-np.expm1(clean), 1e-9, 1)
        pull = np.where(label > 0, (1 - total) / total, -1.0)[doc] * p / n_docs
        g, gb = np.bincount(f, pull[s], minlength=len(w)), float(pull.sum())
        g = np.where(w != 0, g - l1 * np.sign(w), np.sign(g) * np.maximum(np.abs(g) - l1, 0))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.99**step
        moved = w + rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        w = np.maximum(moved, 0)  # features only ever speak for the label
        b += rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    weights[used] = w
    return weights, float(b)


def _featurize(batches):
    for batch in batches:
        for part in chunks(batch):
            feature, sentence, doc, _ = sentences(*text_buffer(part.column("text")))
            at = np.searchsorted(sentence, np.arange(len(doc) + 1))
            per_doc = np.searchsorted(doc, np.arange(part.num_rows + 1))
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "toxic": part.column("toxic"),
                    "feature": pa.ListArray.from_arrays(pa.array(at[per_doc], pa.int32()), pa.array(feature, pa.int32())),
                    "size": pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), pa.array(np.diff(at), pa.int32())),
                }
            )


def fit(docs: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> tuple[np.ndarray, float]:
    """Weights and bias from the labelled documents whose crc32(doc_id) mod 3 is not 1."""
    sample = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(crc_remainder("doc_id", 3) != 1)
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_documents)
    )
    rows = (
        docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(sample), "doc_id")  # at most fit_documents ids
        .select("doc_id", "text", "toxic")
        .mapInArrow(_featurize, "doc_id long, toxic int, feature array<int>, size array<int>")
    )

    def learn(batches):
        """The bounded sample in one task, in one order whatever the partitioning."""
        feature, sizes, per_doc, label = [], [], [], []
        for batch in batches:
            feature.append(batch.column("feature").flatten().to_numpy())
            sizes.append(batch.column("size").flatten().to_numpy())
            per_doc.append(np.diff(batch.column("size").offsets.to_numpy()))
            label.append(batch.column("toxic").to_numpy())
        if not label:
            return
        sizes, per_doc = np.concatenate(sizes), np.concatenate(per_doc)
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        sentence = np.repeat(np.arange(len(sizes)), sizes)
        weights, bias = fit_rows(np.concatenate(feature), sentence, doc, np.concatenate(label).astype(float))
        used = np.flatnonzero(weights)
        yield pa.record_batch(
            {
                "feature": pa.array(np.append(used, -1).astype(np.int32)),
                "weight": pa.array(np.append(weights[used], bias)),
            }
        )

    ordered = rows.repartition(1).sortWithinPartitions("doc_id", F.size("feature"), "toxic")
    weights, bias = np.zeros(FEATURES), -3.0
    for r in ordered.mapInArrow(learn, "feature int, weight double").collect():  # at most FEATURES + 1 rows
        if r["feature"] < 0:
            bias = r["weight"]
        else:
            weights[r["feature"]] = r["weight"]
    return weights, bias


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], spans: bool = True, names: tuple[str, str] = ("_score", "_sentences")
) -> DataFrame:
    """All columns of ``docs`` plus a score (double) and, with ``spans``, the byte start, byte end
    and probability of every sentence at or over ``SPAN_THRESHOLD``, called ``names``; columns of
    ``docs`` with these names are replaced."""
    docs = docs.drop(*names[: 1 + spans])
    weights, bias = model
    weights = weights.astype(np.float32)

    def run(batches):
        empty = float(_sigmoid(np.array([bias]))[0])
        for batch in batches:
            for part in chunks(batch):
                data, offsets = text_buffer(part.column("text"))
                feature, sentence, doc, (begin, finish) = sentences(data, offsets)
                p = sentence_scores(weights, bias, feature, sentence, len(doc))
                columns = [*part.columns, pa.array(noisy_or(p, doc, part.num_rows, empty))]
                if spans:
                    bad = np.flatnonzero(p >= SPAN_THRESHOLD)
                    items = pa.StructArray.from_arrays(
                        [
                            pa.array(begin[bad] - offsets[doc[bad]], pa.int64()),
                            pa.array(finish[bad] - offsets[doc[bad]], pa.int64()),
                            pa.array(p[bad], pa.float64()),
                        ],
                        names=["start", "end", "p"],
                    )
                    lists = pa.array(np.searchsorted(doc[bad], np.arange(part.num_rows + 1)), pa.int32())
                    columns.append(pa.ListArray.from_arrays(lists, items))
                yield pa.RecordBatch.from_arrays(columns, names=out_names)

    out = T.StructType(list(docs.schema.fields)).add(names[0], "double")
    if spans:
        span = T.StructType().add("start", "long").add("end", "long").add("p", "double")
        out = out.add(names[1], T.ArrayType(span))
    out_names = out.names
    return docs.mapInArrow(run, out)


def clean(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; all columns keep their values, whatever their names."""
    name = unused(docs, "score")
    scored = score(docs, model, spans=False, names=(name, ""))
    return scored.filter(F.col(name) < threshold).select(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> DataFrame:
    """``doc_id, held_out, score, predicted, sentences`` for every row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, fit_documents))
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", 3) == 1).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("_sentences").alias("sentences"),
    )
