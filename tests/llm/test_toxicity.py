import random
import zlib

import numpy as np

from tessel.llm import toxicity as X

SCHEMA = "doc_id long, text string, toxic string, score double"


def corpus(n=600):
    rng = random.Random(8)
    words = ["w%d" % i for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=rng.randint(3, 12))).capitalize() + "." for _ in range(rng.randint(1, 9))]
        bad = rng.random() < 0.2
        if bad:
            k = rng.randrange(len(sentences))
            sentences[k] = "You " + rng.choice(["vexing", "vexed", "grumble"]) + " thing, " + sentences[k]
        docs.append((i, " ".join(sentences), "clash", 0.5))
        if rng.random() < 0.8:
            labels.append((i, 1, int(bad)))
    return docs, labels


def test_learns_from_documents_and_finds_sentences(spark):
    docs, labels = corpus()
    docs += [(1000, None, None, None), (1001, "", "", 0.0), (None, "You grumble thing.", "", 0.0), docs[0]]
    labels += [(None, 1, 1), (5000, 1, 1), (1001, 1, None)]
    out = X.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = out.collect()
    assert len(got) == len(docs)
    texts = {d[0]: d[1] for d in docs}
    right = total = 0
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.held_out and r.doc_id is not None and r.doc_id < 1000:
            truth = any(w in texts[r.doc_id] for w in ("vex", "grumble"))
            right, total = right + (truth == bool(r.predicted)), total + 1
            for s in r.sentences if truth and r.predicted else []:
                part = texts[r.doc_id].encode()[s.start : s.end].decode()
                assert "vex" in part or "grumble" in part
    assert total > 100 and right / total > 0.97
    assert all(r.score < 0.5 for r in got if r.doc_id in (1000, 1001))


def test_score_is_the_noisy_or_of_sentences():
    p, doc = np.array([0.5, 0.5, 0.2]), np.array([0, 0, 2])
    assert np.allclose(X.noisy_or(p, doc, 3, 0.01), [0.75, 0.01, 0.2])


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame(corpus(20)[0], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in X.toxicity(docs, none).collect()} == {0}
    assert X.toxicity(docs.limit(0), none).count() == 0


def test_columns_of_any_name(spark):
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, SCHEMA)
    model = X.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    want = {r.doc_id: r._score for r in X.score(df, model, spans=False).collect()}
    clash = df.selectExpr("doc_id", "text", "7.5D AS _score", "'s' AS _sentences", "3 AS score", "doc_id AS _SENTENCE")
    scored = X.score(clash, model)
    assert scored.columns == ["doc_id", "text", "score", "_SENTENCE", "_score", "_sentences"]
    assert {r.doc_id: r._score for r in scored.collect()} == want
    kept = X.clean(clash, model)
    assert kept.columns == clash.columns
    rows = kept.collect()
    assert {r.doc_id for r in rows} == {i for i, s in want.items() if s < X.THRESHOLD}
    assert all(tuple(r)[2:] == (7.5, "s", 3, r.doc_id) for r in rows)


def test_one_very_long_text(spark):
    docs, labels = corpus(300)
    long = " ".join(["w%d word here." % (i % 90) for i in range(60_000)])
    docs += [(900, long, "x", 0.0), (902, long + " You vexing grumble thing.", "x", 0.0)]
    df = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: r for r in X.toxicity(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    (last,) = [s for s in got[902].sentences if s.p > 0.5 and "vexing" in (long + " You vexing grumble thing.")[s.start : s.end]]
    assert last.end >= len(long) and got[902].score >= got[900].score
