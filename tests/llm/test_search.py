import math
import random
import re

import numpy as np
import pytest

from tessel.llm import search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    held = [(i, d[0], terms(d[1])) for i, d in enumerate(docs) if terms(d[1])]
    n, length = len(held), sum(len(t) for *_, t in held)
    out = []
    for item_id, text in items:
        rows = []
        for i, doc_id, words in held:
            m, score = 75 + (25 * len(words) * n) // length, 0
            for t in terms(text):
                df, tf = sum(t in w for *_, w in held), words.count(t)
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                score += weight * ((10**9 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0))
        rows.sort()
        out += [(item_id, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(rows[:k])]
    return sorted(out, key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = ["the", "Of", "é", "x1", "ÀB"] * 3 + ["w%d" % i for i in range(60)]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(vocab, k=rng.choice([0, 1, 5, 9, 9, 9, 200])))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "... !"), (7, "the w1 w2"), (7, "the w1 w2"), (None, "w1 w1 w2"), (503, "w3 " * 5000)]
    docs += [(600 + i, "the w1 w2 same") for i in range(45)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 12)))) for i in range(12)]
    items += [(90, None), (91, "?"), (92, "same same The"), (92, "absent"), (93, "w1 w1 w2"), (None, "w3")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*x, "clash", 1) for x in docs], "doc_id long, text string, m string, score int")
    return d, spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, query string")


@pytest.mark.parametrize("run_postings, pairs, words", [(1 << 19, 1 << 21, 1 << 20), (50, 64, 1 << 20), (300, 1 << 21, 20)])
def test_equals_brute_force(spark, monkeypatch, run_postings, pairs, words):
    """Whatever the runs, the blocks of pairs and the groups of queries."""
    monkeypatch.setattr(S, "RUN_POSTINGS", run_postings)
    monkeypatch.setattr(S, "PAIRS", pairs)
    docs, items = corpus()
    got = S.search(*frames(spark, docs, items), query_words=words).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == brute(docs, items)


def test_bounds_hold_and_skip_strata():
    rng = np.random.default_rng(2)
    queries = S.Queries(["a b c", "c d", "e e f"])
    n, terms_ = 400, len(queries.terms)
    first = np.arange(0, 3 * n + 1, 3)
    doc, term = np.repeat(np.arange(n), 3), np.concatenate([rng.permutation(terms_)[:3] for _ in range(n)])
    tf, m = rng.integers(1, 9, 3 * n), 75 + rng.integers(0, 12, n) * 10
    weight = rng.integers(1, 5000, terms_)
    index = S.Stratum(m, doc, term, tf, weight)
    bound = index.bounds(queries)
    for q, d, s in index.scores(queries, np.ones(bound.shape, bool)):
        of = np.searchsorted(index.strata, m[d])
        assert (s <= bound[of, q]).all()
        for qi, di, si in zip(q, d, s):
            want = 0
            for t, f in zip(term[first[di] : first[di + 1]], tf[first[di] : first[di + 1]]):
                times = queries.times[queries.begin[t] : queries.begin[t + 1]][queries.query[queries.begin[t] : queries.begin[t + 1]] == qi].sum()
                want += int(times) * int(weight[t]) * ((10**9 * int(f)) // (1000 * int(f) + 12 * int(m[di])))
            assert want == si


def test_empty_tables(spark):
    docs, items = corpus()
    d, q = frames(spark, docs, items)
    assert S.search(d.limit(0), q).count() == 0 and S.search(d, q.limit(0)).count() == 0
