import itertools
import random

import numpy as np
import pytest
import xxhash

from tessel.llm import simhash as S
from tessel.plans.components import edge_components

SCHEMA = "doc_id long, text string, lang string, component_id string"


def brute_fp(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w, word = [], ""
    for c in t + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                w.append(word)
            word = ""
        else:
            word += c
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(ids))]


def texts():
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(60)] + ["Ünï", "A", "b"]
    out = [None, "", "  ", "one", "One", "two words", "x " * 3000]
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(4, 300))]
        out.append(" ".join(base))
        for _ in range(3):
            c = list(base)
            c[rng.randrange(len(c))] = rng.choice(vocab)
            out.append("\t".join(c))
    return out + [out[9], out[9]]


def test_matches_brute_force(spark):
    rows = [(i * 7 % 1009, t, "en", "clash") for i, t in enumerate(texts())]
    rows.append(rows[3])  # a repeated row
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in S.simhash_components(df).collect())
    fps = [brute_fp(r[1]) for r in rows]
    comp = brute_components([r[0] for r in rows], fps)
    assert got == sorted((r[0], "%016x" % f, c) for r, f, c in zip(rows, fps, comp))


def test_every_pair_within_the_radius_shares_a_table():
    masks = S.covering_masks((1 << 64) - 1, 3)
    rng = random.Random(1)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(diff & m == 0 for m in masks)


def test_last_level_is_bounded():
    tree = S.mask_tree(3)
    assert max((~m & (1 << 64) - 1).bit_count() for m in tree[-1]) <= 8


@pytest.mark.parametrize("bucket", [4, 256])
def test_crowded_buckets_keep_every_link(spark, bucket):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 9))) for _ in range(400)}
    fps |= {rng.getrandbits(64) for _ in range(100)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = [(r.a, r.b) for r in S.fingerprint_links(df, bucket=bucket).collect()]
    label = {f: f for f in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[max(root(a), root(b))] = min(root(a), root(b))
    mine = [root(f) for f in signed]
    brute = brute_components(signed, [f % 2**64 for f in signed])
    assert len(set(mine)) == len(set(brute)) == len(set(zip(mine, brute)))


def test_components_of_a_shuffled_path(spark):
    ids = list(range(1500))
    random.Random(3).shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, ids[1:])), "src long, dst long")
    assert {r.label for r in edge_components(df).collect()} == {0}


def test_keep_one_and_empty_table(spark):
    rows = [(3, "a b c d", "x", "k"), (1, "a b c d", "y", "k"), (1, "a b c d", "y", "k"), (None, "a b c d", "z", "k")]
    rows += [(9, "quite another text here", None, None), (None, "alone in the world today", "q", "r")]
    kept = S.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "component_id"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "9", "None"]
    assert S.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0
    assert S.simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keep_one_keeps_different_texts_without_or_under_one_id(spark):
    word = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(None, word(k), "x", "n") for k in range(20)]  # no ids, nothing alike
    rows += [(7, word(100 + k), "x", "s") for k in range(5)]  # one id, nothing alike
    rows += [(50, word(200), "x", "c"), (None, word(200), "x", "c"), (40, word(200), "x", "c")]  # copies, one without id
    rows += [(None, word(201), "x", "d"), (None, word(201), "x", "d"), (None, word(201), "y", "d")]  # repeats without id
    kept = [tuple(r) for r in S.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted(map(str, (r[:2] for r in kept if r[3] in "ns"))) == sorted(map(str, (r[:2] for r in rows[:25])))
    assert [r for r in kept if r[3] == "c"] == [(40, word(200), "x", "c")]
    assert len([r for r in kept if r[3] == "d"]) == 1


def test_keep_one_keeps_the_values_of_all_columns(spark):
    names = ["_hash", "hash", "_row", "row_hash", "rank", "_rank", "label", "fp", "src"]
    kinds = ", ".join(f"`{n}` double" for n in names)
    rows = [(i, f"text number {i} of its own kind", *[float(i)] * len(names)) for i in range(6)]
    rows += [(20, rows[0][1], *[9.0] * len(names))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + kinds)
    out = S.keep_one(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == sorted(rows[:6])
