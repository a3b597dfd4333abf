"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap checks.

The test items are the indexed side: an inverted index with BM25 impacts (each
item's impacts divided by its score against itself, so one threshold fits items of
all lengths) and, for every term, the largest impact overall and in each block of
items.  Every training text is cut into overlapping passages twice as long as the
longest item, with steps of one item length, so an item's copy lies whole in some
passage.  A passage is a query:

* terms are taken by falling impact until those left cannot reach the threshold
  together; only the first ones' postings give candidates (the WAND pivot);
* a candidate whose known part plus the other terms' maxima in the item's block stays
  below the threshold is dropped; the others are scored in full;
* every item at or over the threshold is kept, none is cut off at a top k, and is
  verified: at least ``OVERLAP`` of the five-word shingles of its question and of its
  answer (the last sentence; the last third of a one-sentence item) in the passage.

Scoring is numpy over whole batches of passages in one row-local pass over the
texts.  The index travels to the tasks in groups of about ``INDEX_WORDS`` item words, a
pass over the texts for each group, so its size is bounded; document frequencies, lengths
and passage borders are of the whole benchmark, so the groups do not change a result.

Defined cases: a null or empty text matches nothing; an item without words is never
found; items of fewer than five words count as one shingle; repeated rows are
matched each; copies of an item are items of their own.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.words import alnum_separator_table, chunks, shingles, text_buffer, words
from tessel.session import discard, materialize

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of the item's score against itself
OVERLAP = 0.8
SHINGLE = 5
BLOCK_ITEMS = 8  # items in a block, more where that would be over BLOCKS blocks
BLOCKS = 64
DENSE_ITEMS = 2048  # candidates of larger indexes are summed sparsely, with the same result
INDEX_WORDS = 4_000_000  # item words in one broadcast index

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def question_and_answer(text: str) -> tuple[str, str]:
    parts = [p for p in _SENTENCE.split(text) if p.strip()]
    if len(parts) > 1:
        answer = parts[-1]
        return text[: text.rindex(answer)], answer
    w = text.split()
    cut = len(w) - max(1, len(w) // 3)
    return " ".join(w[:cut]), " ".join(w[cut:])


def _hash_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    h, _, _, first = words(*text_buffer(pa.array(texts, pa.large_string())), alnum_separator_table())
    return h, first


def _grams(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingles of one word sequence; a shorter one is a single shingle."""
    if not len(h):
        return h
    return np.unique(shingles(h, np.array([0, len(h)]), min(size, len(h)))[0])


class Statistics(NamedTuple):
    """Of the whole benchmark: items with words, their words, the longest one's words, and the items
    that hold each of some terms (hashes ascending)."""

    items: int
    words: int
    longest: int
    terms: np.ndarray
    df: np.ndarray


class Index:
    """Inverted index of test items; ``statistics`` are those of all items, not only of these."""

    def __init__(self, item_ids: list, texts: list[str], statistics: Statistics):
        h, first = _hash_words(texts)
        keep = np.flatnonzero(np.diff(first) > 0)
        self.item_ids = [item_ids[i] for i in keep]
        self.n = len(keep)
        self.longest = statistics.longest
        self.parts = []
        for i in keep:
            sides = [_hash_words([s])[0] for s in question_and_answer(texts[i])]
            self.parts.append([(s, min(SHINGLE, len(s)), _grams(s)) for s in sides if len(s)])
        length = np.diff(first)[keep]
        item = np.repeat(np.arange(self.n), length)
        term_hash = h[np.repeat(first[keep], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)]
        self.terms, term = np.unique(term_hash, return_inverse=True)
        code, tf = np.unique(term * max(self.n, 1) + item, return_counts=True)  # postings by term, then item
        term, item = code // max(self.n, 1), code % max(self.n, 1)
        df = statistics.df[np.searchsorted(statistics.terms, self.terms)]
        idf = np.log(1 + (statistics.items - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / max(statistics.words / max(statistics.items, 1), 1e-9))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[item]) if len(code) else np.zeros(0)
        impact = impact / np.bincount(item, impact, minlength=self.n)[item] if len(code) else impact
        impact = np.ldexp(np.round(np.ldexp(impact, 40)), -40)  # sums of such steps are exact in any order
        self.code, self.item, self.impact = code, item, impact
        self.begin = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.top = np.maximum.reduceat(impact, self.begin[:-1]) if len(code) else np.zeros(0)
        # largest impact of each term in each block of items; the last block keeps the table small
        self.block_items = max(BLOCK_ITEMS, -(-self.n // BLOCKS))
        self.block_top = np.zeros((len(self.terms), -(-max(self.n, 1) // self.block_items)), np.float32)
        np.maximum.at(self.block_top, (term, item // self.block_items), np.nextafter(impact.astype(np.float32), np.float32(9)))


def _lookup(codes: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, values[at], 0.0)


def _pairs(counts_a: np.ndarray, first_a: np.ndarray, rows: np.ndarray):
    """For each i all members ``first_a[rows[i]] ...`` of its row: (i repeated, members)."""
    n = counts_a[rows]
    who = np.repeat(np.arange(len(rows)), n)
    return who, first_a[rows][who] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, threshold: float):
    """All ``(passage, item, score)`` at or over ``threshold``; ``passage``/``term`` are distinct
    pairs sorted by passage."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not len(passage):
        return none
    top = index.top[term]
    # rising impact inside each passage: terms whose running total stays below the threshold
    # cannot make a match on their own
    order = np.lexsort((top, passage))
    passage, term, top = passage[order], term[order], top[order]
    start = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    total = np.cumsum(top)
    row = np.cumsum(np.append(True, passage[1:] != passage[:-1])) - 1
    running = total - (total[start] - top[start])[row]
    weak = running < threshold - 1e-9
    n_weak = np.bincount(row, weak, minlength=len(start)).astype(np.int64)
    # block maxima of the weak terms, summed for each passage and block of items
    by_block = np.where(weak[:, None], index.block_top[term], np.float32(0))
    weak_block = np.add.reduceat(by_block, start, axis=0)
    strong = np.flatnonzero(~weak)
    if not len(strong):
        return none
    who, posting = _pairs(np.diff(index.begin), index.begin[:-1], term[strong])
    owner, item = row[strong][who], index.item[posting]
    step, found = max(1, (1 << 22) // index.n), []
    cut = np.searchsorted(owner, np.arange(0, len(start) + step, step))
    if index.n > DENSE_ITEMS:
        code, back = np.unique(owner * index.n + item, return_inverse=True)
        known = np.bincount(back, index.impact[posting])
        r, item, cut = code // index.n, code % index.n, []
        at = np.flatnonzero(known + weak_block[r, item // index.block_items] >= threshold - 1e-6)
        found.append((r[at], item[at], known[at]))
    # few items: impacts of the strong terms in a dense table, a run of passages at a time
    for k, (a, b) in enumerate(zip(cut, cut[1:])):
        if a == b:
            continue
        low, high = k * step, min((k + 1) * step, len(start))
        code = (owner[a:b] - low) * index.n + item[a:b]
        known = np.bincount(code, index.impact[posting[a:b]], minlength=(high - low) * index.n)
        bound = known.reshape(high - low, index.n) + np.repeat(weak_block[low:high], index.block_items, axis=1)[:, : index.n]
        at = np.flatnonzero((bound.ravel() >= threshold - 1e-6) & (known > 0))
        found.append((at // index.n + low, at % index.n, known[at]))
    r, item, known = (np.concatenate(x) for x in zip(*found))
    # full scores of what the block maxima leave
    who, at = _pairs(n_weak, start, r)
    known = known + np.bincount(who, _lookup(index.code, index.impact, term[at] * index.n + item[who]), minlength=len(r))
    alive = known >= threshold - 1e-9
    return passage[start[r[alive]]], item[alive], known[alive]


def match_batch(index: Index, data: np.ndarray, offsets: np.ndarray, threshold: float, overlap: float):
    """Verified matches of a batch of texts: ``(text, item, first word, score, question, answer)``,
    the best passage for each text and item."""
    h, _, _, first = words(data, offsets, alnum_separator_table())
    if not len(h) or not index.n:
        return []
    at = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    held = np.flatnonzero(index.terms[at] == h)
    term = at[held]
    text = np.searchsorted(first, held, side="right") - 1
    step = index.longest
    # passage k of a text covers words [k * step, (k + 2) * step): a word is in passages k - 1 and k
    place = (held - first[text]) // step
    base = np.concatenate(([0], np.cumsum(-(-np.diff(first) // step) + 1)))  # passages of the texts before
    ids = base[text] + place
    both = np.concatenate([ids, ids[place > 0] - 1])
    terms = np.concatenate([term, term[place > 0]])
    code = np.unique(both * len(index.terms) + terms)
    found = retrieve(index, code // len(index.terms), code % len(index.terms), threshold)
    best: dict[tuple[int, int], tuple] = {}
    for p, item, score in zip(*(x.tolist() for x in found)):
        i = int(np.searchsorted(base, p, side="right")) - 1
        begin = first[i] + (p - base[i]) * step
        passage = h[begin : min(begin + 2 * step, first[i + 1])]
        shares = []
        for _, size, grams in index.parts[item]:
            have = _grams(passage, size) if len(passage) >= size else np.zeros(0, np.uint64)
            shares.append(np.isin(grams, have, assume_unique=True).mean())
        if min(shares) >= overlap:
            row = (i, item, int(begin - first[i]), score, shares[0], shares[-1])
            if (i, item) not in best or row[3:] > best[i, item][3:]:
                best[i, item] = row
    return [best[k] for k in sorted(best)]


def _item_terms(benchmark: DataFrame) -> DataFrame:
    """``item, n, terms``: a hash of each item, its number of words and their distinct hashes."""

    def run(batches):
        for batch in batches:
            h, _, _, first = words(*text_buffer(batch.column("text")), alnum_separator_table())
            n = np.diff(first)
            code = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((h, code))
            h, code = h[order], code[order]
            new = np.append(True, (h[1:] != h[:-1]) | (code[1:] != code[:-1])) if len(h) else np.zeros(0, bool)
            to = np.searchsorted(code[new], np.arange(len(n) + 1))
            terms = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(h[new].view(np.int64)))
            yield pa.record_batch({"item": batch.column("item"), "n": pa.array(n, pa.int64()), "terms": terms})

    rows = benchmark.select(F.xxhash64("item_id", "text").alias("item"), "text")
    return rows.mapInArrow(run, "item long, n long, terms array<long>")


def item_groups(benchmark: DataFrame, index_words: int = INDEX_WORDS):
    """The items in groups of about ``index_words`` words, each group collected in turn.  All groups
    share the statistics of the whole benchmark, so results do not depend on the groups."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    terms, path = materialize(_item_terms(rows), "items")
    sizes = terms.agg(
        F.sum((F.col("n") > 0).cast("long")).alias("items"), F.sum("n").alias("words"), F.max("n").alias("longest")
    ).first()
    of_terms = terms.select("item", F.explode("terms").alias("term"))
    df, df_path = materialize(of_terms.groupBy("term").agg(F.count("*").alias("df")), "item_terms")
    groups = 1 + (sizes["words"] or 0) // index_words
    group = lambda item: F.pmod(item, F.lit(groups))
    for g in range(groups):
        mine = of_terms.filter(group(F.col("item")) == g).select("term").distinct()
        held = df.join(mine, "term", "left_semi").collect()  # bounded by index_words, as the items are
        held = np.array(sorted((r["term"] % (1 << 64), r["df"]) for r in held), dtype=np.uint64).reshape(-1, 2)
        known = Statistics(
            sizes["items"] or 0, sizes["words"] or 0, sizes["longest"] or 0, held[:, 0], held[:, 1].astype(np.int64)
        )
        found = rows.filter(group(F.xxhash64("item_id", "text")) == g).orderBy("item_id", "text").collect()
        yield Index([r["item_id"] for r in found], [r["text"] for r in found], known)
    discard(rows.sparkSession, path, df_path)


def matches(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """``doc_id, item_id, first_word, score, question, answer`` for every verified match."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, first_word long, score double, question double, answer double"
    out = None
    for index in item_groups(benchmark, index_words):

        def run(batches, index=index):
            for batch in batches:
                for part in chunks(batch):
                    found = match_batch(index, *text_buffer(part.column("text")), threshold, overlap)
                    if found:
                        text, item, at, score, question, answer = zip(*found)
                        yield pa.record_batch(
                            {
                                "doc_id": part.column("doc_id").take(pa.array(text)),
                                "item_id": pa.array([index.item_ids[i] for i in item]),
                                "first_word": pa.array(at, pa.int64()),
                                "score": pa.array(score, pa.float64()),
                                "question": pa.array(question, pa.float64()),
                                "answer": pa.array(answer, pa.float64()),
                            }
                        )

        some = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = some if out is None else out.unionByName(some)
    return out


def clean(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """The rows of ``docs`` without a verified match; row-local."""
    for index in item_groups(benchmark, index_words):

        def run(batches, index=index):
            for batch in batches:
                for part in chunks(batch):
                    found = match_batch(index, *text_buffer(part.column("text")), threshold, overlap)
                    keep = np.ones(part.num_rows, bool)
                    keep[[f[0] for f in found]] = False
                    yield part.filter(pa.array(keep)) if found else part

        docs = docs.mapInArrow(run, docs.schema)
    return docs
