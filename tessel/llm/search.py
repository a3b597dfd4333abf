"""Ranked lexical search over a length-stratified index.

A document's score for a query is a sum over the query's terms of a term weight times an
impact that depends on the term's frequency in the document and on the document's
normaliser ``m`` alone.  Documents are therefore grouped by equal ``m``: in such a
stratum the postings of a term are stored by frequency, and the impact of each
frequency is computed once, whatever the number of documents that have it.

1.  One pass over the texts writes a forward table: each document's number of terms and
    its frequencies of the terms that queries hold (all documents, no other terms).
2.  Aggregates over it give the corpus statistics and the document frequencies.
3.  The rows are range-sorted by ``m`` (then by hash, so a stratum that a third of all
    documents share is split over tasks).  A task builds strata from bounded runs of
    documents.  The largest impact of each term in a stratum gives every query's bound
    there; a query visits its strata by falling bound, and those whose bound is below the
    score of its ``k``-th best document so far are left out, exactly.
4.  Each task's best ``k`` of every query meet in a window ranking.

Queries travel to the tasks in groups of at most ``QUERY_WORDS`` words, a pass for each
group; statistics are of the corpus, so results do not depend on the groups.  Terms are
told apart by 64-bit hashes.

Defined cases: null and empty texts and texts without terms are not ranked and count
neither in ``N`` nor in ``L``; a query without terms has no rows; rows that share an id are
documents of their own, and queries that share an id queries of their own; equal scores
rank by ascending ``doc_id``, rows without one last; empty tables give an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessel.llm.words import alnum_separator_table, chunks, text_buffer, words
from tessel.session import discard, materialize

TOP = 20
QUERY_WORDS = 1_000_000
RUN_POSTINGS = 1 << 19  # postings of one run of documents
PAIRS = 1 << 21  # postings times queries scored at once
IMPACT, TF, NORM = 1_000_000_000, 1000, 12


def _expand(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``begin[i] ... begin[i] + count[i] - 1`` for every i: (i repeated, members)."""
    who = np.repeat(np.arange(len(count)), count)
    return who, begin[who] + np.arange(len(who)) - (np.cumsum(count) - count)[who]


class Queries:
    """Distinct terms of some queries with the times each stands in a query, by term."""

    def __init__(self, texts: list[str]):
        h, _, _, first = words(*text_buffer(pa.array(texts, pa.large_string())), alnum_separator_table())
        self.n = len(texts)
        self.terms, term = np.unique(h, return_inverse=True)
        query = np.repeat(np.arange(self.n), np.diff(first))
        code, self.times = np.unique(term.astype(np.int64) * max(self.n, 1) + query, return_counts=True)
        self.query = code % max(self.n, 1)
        self.begin = np.searchsorted(code // max(self.n, 1), np.arange(len(self.terms) + 1))


def forward_table(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, tfs`` for every document with a term: frequencies of ``terms`` by their place."""

    def run(batches):
        separators = alnum_separator_table()
        for batch in batches:
            for part in chunks(batch):
                h, _, _, first = words(*text_buffer(part.column("text")), separators)
                n = np.diff(first)
                doc = np.repeat(np.arange(part.num_rows), n)
                at = np.minimum(np.searchsorted(terms, h), max(len(terms) - 1, 0))
                held = terms[at] == h if len(terms) else np.zeros(len(h), bool)
                code, tf = np.unique(doc[held] * max(len(terms), 1) + at[held], return_counts=True)
                to = np.searchsorted(code // max(len(terms), 1), np.arange(part.num_rows + 1))
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(x, kind))  # noqa: B023, E731
                rows = pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array(n, pa.int64()),
                        "terms": lists(code % max(len(terms), 1), pa.int32()),
                        "tfs": lists(tf, pa.int64()),
                    }
                )
                yield rows.filter(pa.array(n > 0))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


def document_frequencies(forward: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term: counted in every task, then summed by term."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(held, pa.int32()), "df": pa.array(total[held])})

    out = np.zeros(n_terms, np.int64)
    counted = forward.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.collect():  # at most the terms of a group of queries
        out[r["term"]] = r["df"]
    return out


class Stratum:
    """Postings of a run of documents in strata of equal ``m``, ordered by (stratum, term, tf)."""

    def __init__(self, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray):
        self.strata, stratum = np.unique(m, return_inverse=True)
        n_terms = len(weight)
        stratum = stratum[doc]
        order = np.lexsort((tf, term, stratum))
        self.doc, self.term, self.stratum = doc[order], term[order], stratum[order]
        tf = tf[order]
        code = self.stratum * n_terms + self.term
        new = np.append(True, (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])) if len(code) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        impact = (IMPACT * tf[head]) // (TF * tf[head] + NORM * self.strata[self.stratum[head]])  # once per tf
        self.gain = (impact * weight[self.term[head]])[np.cumsum(new) - 1]  # of every posting
        # impacts rise with tf: the last posting of a (stratum, term) has the largest
        last = np.flatnonzero(np.append(code[1:] != code[:-1], True)) if len(code) else np.zeros(0, np.int64)
        self.top_term, self.top_stratum, self.top = self.term[last], self.stratum[last], self.gain[last]
        self.by_doc = np.argsort(self.doc, kind="stable")  # a document's postings together

    def bounds(self, queries: Queries) -> np.ndarray:
        """No document of a stratum scores more for a query: (strata, queries)."""
        out = np.zeros(len(self.strata) * queries.n, np.int64)
        count = np.diff(queries.begin)[self.top_term]
        step = max(1, PAIRS // max(queries.n, 1))
        for i in range(0, len(count), step):
            who, at = _expand(queries.begin[self.top_term[i : i + step]], count[i : i + step])
            np.add.at(out, self.top_stratum[i : i + step][who] * queries.n + queries.query[at], self.top[i : i + step][who] * queries.times[at])
        return out.reshape(len(self.strata), queries.n)

    def scores(self, queries: Queries, visit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(query, document, score)`` of all documents with a score in the visited (stratum, query)."""
        doc = self.by_doc[visit.any(axis=1)[self.stratum[self.by_doc]]]
        count = np.diff(queries.begin)[self.term[doc]]
        total = np.cumsum(count)
        at, n = 0, len(doc)
        new = np.append(np.flatnonzero(np.append(True, self.doc[doc][1:] != self.doc[doc][:-1])), n) if n else np.zeros(1, np.int64)
        while at < n:
            reach = int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS))
            to = new[np.searchsorted(new, reach, side="right") - 1]
            to = int(to if to > at else new[np.searchsorted(new, at, side="right")])  # at least one document
            some = doc[at:to]
            who, q = _expand(queries.begin[self.term[some]], count[at:to])
            query = queries.query[q]
            seen = visit[self.stratum[some][who], query]
            who, q, query = who[seen], q[seen], query[seen]
            code, back = np.unique(query * (np.int64(self.doc.max()) + 1) + self.doc[some][who], return_inverse=True)
            sums = np.zeros(len(code), np.int64)
            np.add.at(sums, back, self.gain[some][who] * queries.times[q])
            yield code // (self.doc.max() + 1), code % (self.doc.max() + 1), sums
            at = to


def _best(found: pa.Table, k: int) -> pa.Table:
    """The first ``k`` of every query by score, then id."""
    found = found.take(pc.sort_indices(found, [("query", "ascending"), ("score", "descending"), ("doc_id", "ascending")]))
    query = found.column("query").to_numpy()
    start = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
    place = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
    return found.filter(pa.array(place < k))


def search_run(queries: Queries, weight, ids: pa.Array, m, first, term, tf, best: pa.Table | None, k: int) -> pa.Table | None:
    """Best ``k`` of every query after a run of documents (``first``: where each one's postings begin)."""
    doc = np.repeat(np.arange(len(m)), np.diff(first))
    index = Stratum(m, doc, term, tf, weight)
    if not len(index.doc) or not queries.n:
        return best
    bound = index.bounds(queries)
    order = np.argsort(-bound, axis=0, kind="stable")
    begin, size = 0, 1
    while begin < len(index.strata):
        least = np.ones(queries.n, np.int64)  # score above 0
        if best is not None and len(best):
            query, score = best.column("query").to_numpy(), best.column("score").to_numpy()
            full = np.bincount(query, minlength=queries.n) >= k
            low = np.full(queries.n, np.iinfo(np.int64).max)
            np.minimum.at(low, query, score)
            least[full] = low[full]
        visit = np.zeros(bound.shape, bool)
        some = order[begin : begin + size]
        np.put_along_axis(visit, some, True, axis=0)
        visit &= bound >= least  # equal scores may still come first by id
        if not visit.any():
            break  # bounds only fall from here on
        for query, at, score in index.scores(queries, visit):
            good = score >= least[query]
            found = pa.table({"query": query[good], "score": score[good], "doc_id": ids.take(pa.array(at[good]))})
            best = _best(found if best is None else pa.concat_tables([best, found]), k)
        begin, size = begin + size, size * 4
    return best


def _runs(batches):
    """Rows sorted by ``m`` in runs of about ``RUN_POSTINGS`` postings."""
    held, n = [], 0
    for batch in batches:
        size = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            total = n + np.cumsum(size[at:])
            to = at + max(int(np.searchsorted(total, RUN_POSTINGS)), 0 if n else 1)
            held.append(batch.slice(at, to - at))
            n += int(size[at:to].sum())
            if to < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
            at = to
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _ranked(docs: DataFrame, texts: list[str], k: int) -> DataFrame:
    """``query, doc_id, score`` of each task's best ``k`` documents for ``texts``."""
    spark = docs.sparkSession
    queries = Queries(texts)
    forward, path = materialize(forward_table(docs, queries.terms), "forward")
    row = forward.agg(F.count("*").alias("docs"), F.sum("n").cast("decimal(38,0)").alias("terms")).first()
    n_docs, n_terms = row["docs"], int(row["terms"] or 0)
    df = document_frequencies(forward, len(queries.terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    # 128-bit decimals: 25 * n * N passes 64 bits on large corpora
    norm = F.expr(f"75 + (CAST(n AS DECIMAL(19,0)) * {25 * n_docs}BD) DIV {max(n_terms, 1)}BD")
    rows = forward.filter(F.size("terms") > 0).withColumn("m", norm)
    tie = F.xxhash64("n", "terms", "tfs", "doc_id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_tie", tie).repartitionByRange(parts, "m", "_tie").sortWithinPartitions("m", "_tie")

    def run(batches):
        best = None
        for table in _runs(batches):
            terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            first = np.append(0, np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False)))
            best = search_run(
                queries, weight, table.column("doc_id").combine_chunks(), table.column("m").to_numpy(), first,
                terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy(), best, k,
            )
        if best is not None and len(best):
            yield from best.select(["query", "doc_id", "score"]).combine_chunks().to_batches()

    kind = docs.schema["doc_id"].dataType.simpleString()
    found, _ = materialize(rows.mapInArrow(run, f"query long, doc_id {kind}, score long"), "ranked")
    discard(spark, path)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, query_words: int = QUERY_WORDS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents for every row of ``queries`` (``item_id, text``)."""
    spark = docs.sparkSession
    rows = queries.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = 1 + total // (6 * query_words)
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
    item_kind, doc_kind = queries.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    schema = f"item_id {item_kind.simpleString()}, rank int, doc_id {doc_kind.simpleString()}, score long"
    out = None
    for g in range(groups):
        some = rows.filter(group == g).collect()  # bounded by query_words
        if not some:
            continue
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(some)], f"query long, item_id {item_kind.simpleString()}"
        )
        found = _ranked(docs, [r["text"] for r in some], k).join(F.broadcast(names), "query")
        found = found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def oracle_sql(k: int = TOP) -> str:
    """``search`` of ``documents`` for ``benchmark`` as DuckDB SQL: every pair scored."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = (
        f"unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t"
    )
    return (
        f"WITH w AS (SELECT doc_id, {terms} FROM documents), "
        "p AS (SELECT doc_id, t, count(*) AS tf FROM w GROUP BY ALL), "
        "d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY ALL), "
        "s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d), "
        "f AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t, nd), "
        f"q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, {terms} FROM benchmark) GROUP BY ALL), "
        "m AS (SELECT doc_id, 75 + (25 * n * nd) // l AS m FROM d, s), "
        f"r AS (SELECT item_id, doc_id, CAST(sum(times * w * (({IMPACT} * tf) // ({TF} * tf + {NORM} * m))) AS BIGINT) AS score "
        "FROM q JOIN f USING (t) JOIN p USING (t) JOIN m USING (doc_id) GROUP BY ALL), "
        "o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) "
        f"SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= {k}"
    )
