import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tessel.llm import fingerprints as I
from tessel.llm.words import text_buffer

SCHEMA = "doc_id long, text string, fingerprint string, n_chars string"


def corpus():
    rng = random.Random(3)
    words = ["alpha", "über", "gamma.", "delta", "épsilon", "日本"] + ["w%d" % i for i in range(40)]
    out = [(i * 3, rng.choice([" ", "\n"]).join(rng.choices(words, k=rng.randint(0, 200)))) for i in range(120)]
    out += [(1, None), (2, ""), (7, "same line\n" * 50), (8, "same line\n" * 50), (8, "  "), (None, "no id"), (9, "x" * 9000)]
    return [(a, b, "clash", "clash") for a, b in out]


def test_matches_brute_force(spark):
    rows = corpus()
    got = I.compare(spark.createDataFrame(rows, SCHEMA)).collect()
    ordered = sorted(((a, b or "") for a, b, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (doc_id, t) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        k = len(t) // 4
        edited = t[: len(t) - k] + following[:k]
        near = []
        for other in (edited, following):
            keys, first = I.paragraphs(*text_buffer(pa.array([t, other])))
            a, b = Counter(keys[: first[1]].tolist()), Counter(keys[first[1] :].tolist())
            n, d = len(keys), ((a - b) + (b - a)).total()
            near.append(1.0 if n == 0 else 1 - d / n)
        want.append((str(doc_id), len(t), hashlib.sha256(edited.encode()).hexdigest(), *near))
    key = lambda r: (r[0], r[1], r[2])
    mine = sorted(((str(r.doc_id), r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=key)
    for g, w in zip(mine, sorted(want, key=key), strict=True):
        assert g[:3] == w[:3] and np.allclose(g[3:], w[3:])
    by_text = {}
    texts = {(str(a), len(b or "")): b or "" for a, b, *_ in rows}
    for r in got:
        by_text.setdefault(texts[str(r.doc_id), r.n_chars], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)


def test_peeling_recovers_the_differing_digests():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 40, dtype=np.uint64) for _ in range(2))
    shared = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    sketch = [I.Sketches.build(np.concatenate([shared, x]), np.array([0, 1040]), 240) for x in (a, b)]
    text, key, sign, decoded = sketch[0].minus(sketch[1]).peel()
    assert decoded.all()
    assert set(key[sign > 0].tolist()) == set(a.tolist()) and set(key[sign < 0].tolist()) == set(b.tolist())


def test_edge_tables(spark):
    assert I.compare(spark.createDataFrame([], SCHEMA)).count() == 0
    one = I.compare(spark.createDataFrame([(5, "a b c d", "", "")], SCHEMA)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
