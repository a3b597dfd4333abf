import math
import random
import re
import struct

import pytest
import xxhash

from tessel.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def hash_words(w):
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    long = lambda x, seed: xxhash.xxh64_intdigest(struct.pack("<q", signed(x)), seed)
    apart = lambda seed: xxhash.xxh64_intdigest(struct.pack("<i", 1), seed)
    two = [apart(long(b, long(a, 42))) for a, b in zip(h, h[1:])] + [apart(long(a, 42)) for a in h[-1:]]
    return h, two


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    under = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(under),
        len(w) < 20 or 100 * len(under) > 30 * len(w),
    )


def brute(docs, good, keep=Q.KEEP, buckets=Q.BUCKETS):
    raw, target = [0] * buckets, [0] * buckets
    grams = []
    for doc_id, text in docs:
        one, two = hash_words(WORD.findall(text or ""))
        grams.append([signed(h) % buckets for h in one + two])
        for b in grams[-1]:
            raw[b] += 1
            target[b] += doc_id in good
    every = math.log((sum(raw) + buckets) / (sum(target) + buckets))
    ratio = [round(10**6 * (math.log((t + 1) / (r + 1)) + every)) for t, r in zip(target, raw)]
    scores = [sum(ratio[b] for b in g) / (2e6 * max(len(g) // 2, 1)) if any(target) else 0.0 for g in grams]
    mine = sorted(math.floor(1000 * s) for s, d in zip(scores, docs) if d[0] in good and not rules(d[1])[-1])
    least = None
    for k in mine:
        if sum(x >= k for x in mine) >= keep * len(mine):
            least = k / 1000
    kept = [not rules(d[1])[-1] and (least is None or s >= least) for s, d in zip(scores, docs)]
    return [(d[0], *rules(d[1]), s, k) for d, s, k in zip(docs, scores, kept)]


def corpus(seed=2):
    rng = random.Random(seed)
    vocab = ["the", "of", "ä", "und", "𝒳y"] * 4 + ["w%d" % i for i in range(300)]
    docs, labels = [], []
    for i in range(140):
        w = rng.choices(vocab, k=rng.choice([5, 19, 20, 40, 90, 200]))
        junk = i % 4 == 0
        if junk:
            w = [x + rng.choice(["%%%", "&&&", "|"]) for x in w]
        if i % 7 == 0:
            w += w[3:15] * rng.randint(1, 3)
        text = "".join(x + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for x in w)
        if i % 5 == 0:
            text += "\nsame line\n \nsame line\nsame line "
        docs.append((i, text))
        if i % 3:
            labels.append((i, int(not junk)))
    docs += [(900, None), (901, ""), (902, " \n\t"), (3, docs[3][1]), (None, docs[5][1]), (903, "a b c d e f g h " * 3000)]
    docs += [(904, "x y z " * 20), (905, "one two three four five six seven eight nine ten " * 2 + "last")]
    labels += [(None, 1), (1, 0), (2, 1), (2, 1), (999, 1), (5, None)]
    return docs, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame([(*x, 1, "clash") for x in docs], "doc_id long, text string, _h int, trusted_id string")
    return d, spark.createDataFrame(labels, "doc_id long, quality int")


def good_ids(labels):
    ids = {i for i, _ in labels if i is not None}
    return {i for i in ids if all(q != 0 for j, q in labels if j == i) and any(q == 1 for j, q in labels if j == i)}


@pytest.mark.parametrize("keep", [Q.KEEP, 0.8])
def test_equals_brute_force(spark, keep):
    docs, labels = corpus()
    got = Q.quality(*frames(spark, docs, labels), keep=keep).collect()
    want = brute(docs, good_ids(labels), keep)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1:8], r[8])
    mine = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.score, r.kept)
        for r in got
    ]
    for a, b in zip(sorted(mine, key=key), sorted(want, key=key)):
        assert a[:7] == b[:7] and a[8] == b[8] and abs(a[7] - b[7]) < 1e-9, (a, b)


def test_held_out_documents_are_told_apart(spark):
    """Trusted labels of half the documents; the other half is judged."""
    rng = random.Random(8)
    good = ["g%d" % i for i in range(200)]
    bad = ["b%d" % i for i in range(200)]
    docs = [(i, " ".join(rng.choices(bad if i % 3 == 0 else good, k=60))) for i in range(240)]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 240, 2)]
    got = {r.doc_id: r.kept for r in Q.quality(*frames(spark, docs, labels)).collect()}
    out = [i for i in range(1, 240, 2)]
    assert sum(got[i] for i in out if i % 3) >= 0.95 * sum(1 for i in out if i % 3)
    assert not any(got[i] for i in out if i % 3 == 0)


def test_without_trusted_documents_or_rows(spark):
    docs, labels = corpus()
    d, la = frames(spark, docs, labels)
    got = Q.quality(d, la.limit(0)).collect()
    assert len(got) == len(docs) and all(r.kept != r.base_failed and r.score == 0 for r in got)
    assert Q.quality(d.limit(0), la).count() == 0


def test_plan_has_no_python(spark):
    docs, labels = corpus()
    d, _ = frames(spark, docs, labels)
    plan = Q.score(d, [0] * 16)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
