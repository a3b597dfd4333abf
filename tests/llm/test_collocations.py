import random
import re
from collections import Counter, defaultdict

import pytest

from tessel.llm import collocations as C


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(docs, longest, threshold, top, holds=50):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            sizes[lang] += len(w)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        dropped = set()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i : i + m]
                    if 100 * a >= holds * cand[q]:
                        dropped.add(q)
        rows = []
        for p, a in cand.items():
            if p not in dropped:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        rows.sort()
        out += [(lang, i + 1, p.decode(), -a, le, r, sizes[lang], -s) for i, (s, a, p, le, r) in enumerate(rows[:top])]
    return sorted(out)


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["the", "Of", "é", "|", "x-1", "ÀB"] + ["w%d" % i for i in range(25)]
    docs = []
    for i in range(160):
        parts = []
        for _ in range(rng.randint(0, 12)):
            w = rng.choices(vocab, k=rng.randint(1, 7))
            if rng.random() < 0.4:
                w += ["New", "york", "city"] if rng.random() < 0.7 else ["new", "york"]
            parts.append(rng.choice([" ", "\t", "  "]).join(w))
        docs.append((rng.choice([". ", ", ", "\n", "!?", " "]).join(parts), rng.choice(["en", "en", "de", None])))
    docs += [(None, "en"), ("", "xx"), ("...", "xx"), ("late " * 9, "en"), ("late late", "en"), ("a b " * 4000, "long")]
    docs += [("rare pair here", "zz")] * 12 + [("same copy of a row", "en")] * 30
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "clash") for d in docs], "text string, lang string, n int, shard string")


@pytest.mark.parametrize("longest, shards, slots", [(3, 3, 1 << 22), (3, 1, 1 << 10), (3, 4, 8), (4, 2, 64)])
def test_equals_brute_force(spark, longest, shards, slots):
    """Whatever the shards, the slots (phrases share them) and the longest phrase."""
    docs = corpus()
    got = C.collocations(frame(spark, docs).repartition(5), longest=longest, shards=shards, slots=slots).collect()
    assert sorted(map(tuple, got)) == brute(docs, longest, 10, 2000)


def test_ties_at_the_end_of_the_list(spark):
    docs = corpus(5)
    got = C.collocations(frame(spark, docs), top=7, threshold=3).collect()
    assert sorted(map(tuple, got)) == brute(docs, 3, 3, 7)


def test_late_phrases_get_a_whole_cycle(spark):
    """Words that reach the threshold in the last shard activate phrases that wrap around."""
    docs = [("alpha beta gamma", "en")] * 3 + [("x y z . alpha beta gamma", "en")] * 20
    got = C.collocations(frame(spark, docs).coalesce(1), shards=3).collect()
    assert sorted(map(tuple, got)) == brute(docs, 3, 10, 2000)


def test_empty_table(spark):
    assert C.collocations(frame(spark, corpus()).limit(0)).count() == 0
