import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tessel.llm import ppm
from tessel.llm.words import crc_remainder

SCHEMA = "doc_id long, text string, score string, train string"


def corpus():
    rng = random.Random(9)
    syllables = ["ba", "né", "Tor", "li", "zu", "日"]
    out = []
    for i in range(70):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(0, 40))]
        out.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    out += [(100, None), (101, ""), (102, "\x00\x01 zq"), (5, out[5][1]), (None, "ba né"), (103, "ab" * 500)]
    return [(a, b, "clash", "clash") for a, b in out]


def brute(rows):
    held = [zlib.crc32(("" if a is None else str(a)).encode()) % 7 == 2 for a, *_ in rows]
    texts = [(b or "").encode() for _, b, *_ in rows]
    seen = [defaultdict(Counter) for _ in range(5)]
    words = Counter()

    def tokens(t):
        lower = bytes(c + 32 if 65 <= c <= 90 else c for c in t)
        return re.findall(rb"[^\x20\x09-\x0D]+", lower) + [None]

    def symbols(t):
        return [256] * 4 + list(t) + [256]

    for t, h in zip(texts, held):
        if not h:
            words.update(tokens(t))
            s = symbols(t)
            for i in range(4, len(s)):
                for k in range(5):
                    seen[k][tuple(s[i - k : i])][s[i]] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for (doc_id, *_), t, h in zip(rows, texts, held):
        w = tokens(t)
        base = sum(math.log10((words[x] + 1) / (n + (v + 1))) for x in w)
        score, s = 0.0, symbols(t)
        for i in range(4, len(s)):
            excluded, p = set(), 1.0
            for k in range(4, -1, -1):
                left = {a: c for a, c in seen[k][tuple(s[i - k : i])].items() if a not in excluded}
                if s[i] in left:
                    p *= left[s[i]] / (sum(left.values()) + len(left))
                    break
                if left:
                    p *= len(left) / (sum(left.values()) + len(left))
                excluded |= set(left)
            else:
                p /= 257 - len(excluded)
            score += math.log10(p)
        out.append((str(doc_id), h, len(w), sum(words[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 25, 900])
def test_matches_brute_force(spark, block_bytes):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = ppm.score(df, crc_remainder("doc_id", 7) != 2, block_bytes).collect()
    mine = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    for g, w in zip(mine, sorted(brute(rows)), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6], rel=1e-5)


def test_edge_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    train = crc_remainder("doc_id", 7) != 2
    assert ppm.score(empty, train).count() == 0
    untaught = ppm.score(spark.createDataFrame([(1, "ab", "", "")], SCHEMA), train & (train.isNull())).collect()
    assert untaught[0].score == pytest.approx(-3 * math.log10(257), rel=1e-5)
