import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tessel.llm import decontaminate as D
from tessel.llm.words import text_buffer

SCHEMA = "doc_id long, text string, item_id string, score string"


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["the", "of", "and"] * 6 + ["v%d" % i for i in range(150)]
    sentence = lambda: " ".join(rng.choices(vocab, k=rng.randint(4, 12))).capitalize() + "."
    items = [(i, " ".join(sentence() for _ in range(rng.randint(1, 4)))) for i in range(90)]
    items += [(200, None), (201, "..."), (202, "two words"), (203, items[0][1])]
    docs = []
    for i in range(160):
        parts = [sentence() for _ in range(rng.randint(0, 40))]
        if i % 4 == 0:
            t = rng.choice(items[:90])[1].split()
            for _ in range(rng.choice([0, 0, 1, 9])):
                t[rng.randrange(len(t))] = "changed"
            parts.insert(rng.randint(0, len(parts)), " ".join(t).upper() if i % 8 else " ".join(t))
        docs.append((i, "\n".join(parts), "clash", "clash"))
    docs += [(500, None, "", ""), (501, "", "", ""), docs[0], (None, items[5][1], None, None)]
    return docs, items


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def sides(text):
    """Question and answer: the last sentence is the answer; of a single one the last third."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if p.strip()]
    if len(parts) > 1:
        return tokens(text[: text.rindex(parts[-1])]), tokens(parts[-1])
    w = text.split()
    cut = len(w) - max(1, len(w) // 3)
    return tokens(" ".join(w[:cut])), tokens(" ".join(w[cut:]))


def grams(w, size):
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(docs, items):
    """Every passage against every item: BM25 written out, then the overlap check on word tuples."""
    held = [(i, tokens(t), [s for s in sides(t) if s]) for i, t in items if tokens(t)]
    n, mean, longest = len(held), sum(len(w) for _, w, _ in held) / len(held), max(len(w) for _, w, _ in held)
    df = Counter(t for _, w, _ in held for t in set(w))

    def impacts(w):
        norm = D.K1 * (1 - D.B + D.B * len(w) / mean)
        got = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (D.K1 + 1) / (f + norm) for t, f in Counter(w).items()}
        return {t: g / sum(got.values()) for t, g in got.items()}

    scored = [(i, impacts(w), [(min(D.SHINGLE, len(s)), s) for s in parts]) for i, w, parts in held]
    out = set()
    for row, (_, text, *_) in enumerate(docs):
        w = tokens(text)
        for start in range(0, len(w) + 1, longest):
            passage = w[start : start + 2 * longest]
            have = set(passage)
            for i, impact, parts in scored:
                if sum(g for t, g in impact.items() if t in have) < D.THRESHOLD - 1e-9:
                    continue
                if all(len(grams(s, k) & grams(passage, k)) >= D.OVERLAP * len(grams(s, k)) for k, s in parts):
                    out.add((row, i))
    return out


def whole_index(items):
    """The index of all items, with their own statistics."""
    h, first = D._hash_words([t or "" for _, t in items])
    n = np.diff(first)
    terms = [set(h[a:b].tolist()) for a, b in zip(first, first[1:])]
    df = Counter(t for x in terms for t in x)
    known = np.array(sorted(df), np.uint64)
    counts = np.array([df[int(t)] for t in known])
    return D.Index([i for i, _ in items], [t or "" for _, t in items], D.Statistics(int((n > 0).sum()), int(n.sum()), int(n.max()), known, counts))


def test_finds_what_plain_scoring_finds():
    docs, items = corpus()
    index = whole_index(items)
    found = D.match_batch(index, *text_buffer(pa.array([d[1] for d in docs])), D.THRESHOLD, D.OVERLAP)
    want = brute(docs, items)
    assert len(want) > 20
    assert {(f[0], index.item_ids[f[1]]) for f in found} == want


def test_tables_groups_and_pipeline_rows(spark):
    docs, items = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(docs[r][0]), i) for r, i in brute(docs, items))
    assert sorted((str(r.doc_id), r.item_id) for r in D.matches(df, bench).collect()) == want
    left = D.clean(df, bench)
    assert left.columns == df.columns
    dirty = {d for d, _ in want}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d[0]) for d in docs if str(d[0]) not in dirty)
    every = sorted((tuple(r) for r in D.matches(df, bench).collect()), key=str)
    for words in (2000, 700, 60):  # groups of items share the statistics of all: the same rows and scores
        assert sorted((tuple(r) for r in D.matches(df, bench, index_words=words).collect()), key=str) == every
    assert sorted(str(r.doc_id) for r in D.clean(df, bench, index_words=700).collect()) == sorted(str(r.doc_id) for r in left.collect())
    assert D.matches(df.limit(0), bench).count() == 0
    assert D.matches(df, bench.limit(0)).count() == 0 and D.clean(df, bench.limit(0)).count() == len(docs)


def test_sparse_candidates_give_the_same(monkeypatch):
    docs, items = corpus(7)
    index = whole_index(items)
    buffer = text_buffer(pa.array([d[1] for d in docs]))
    dense = D.match_batch(index, *buffer, D.THRESHOLD, D.OVERLAP)
    monkeypatch.setattr(D, "DENSE_ITEMS", 0)
    assert [f[:3] for f in D.match_batch(index, *buffer, D.THRESHOLD, D.OVERLAP)] == [f[:3] for f in dense]


def test_one_very_long_text(spark):
    docs, items = corpus()
    filler = ["q%d" % (i % 777) for i in range(60_000)]
    filler[30_000:30_000] = items[4][1].split()
    df = spark.createDataFrame([(1, " ".join(filler), "x", "y"), docs[0]], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert 4 in {r.item_id for r in D.matches(df, bench).collect() if r.doc_id == 1}
