import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tessel.llm import packing as P
from tessel.llm import tokens as K

SCHEMA = "doc_id long, text string, sequence_id string, length string"


def docs():
    rng = random.Random(4)
    words = ["alpha", "beta,", "Gamma.", "über", "x1", "the", "of"]
    out = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 20, 40, 90])))) for i in range(150)]
    out += [(200, None), (201, ""), (7, "again"), (7, "again"), (None, "no id"), (300, "long " * 1000)]
    return [(a, b, "clash", "clash") for a, b in out]


def test_pieces_are_complete_and_sequences_gapless(spark):
    rows, cap = docs(), 64
    df = spark.createDataFrame(rows, SCHEMA)
    got = P.packed_documents(df, K.default_tokenizer(), cap, with_ids=True).collect()
    t = Tokenizer.from_file(K.default_tokenizer())
    want = []
    for doc_id, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(-(-len(ids) // cap)):
            part = ids[k * cap : (k + 1) * cap]
            want.append((str(doc_id), k, k * cap, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= cap
    assert len(places) <= 1.05 * sum(w[3] for w in want) / cap + 1


def serial(lengths, cap):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(cap - n)
    return len(gaps)


def test_as_good_as_serial_best_fit():
    rng = random.Random(6)
    for cap in (10, 37, 100):
        for _ in range(20):
            lengths = [rng.randint(1, rng.choice([cap, cap // 2, cap // 3])) for _ in range(200)]
            counts = {n: lengths.count(n) for n in set(lengths)}
            runs = P.best_fit(counts, cap)
            assert runs[:, 2].sum() == len(lengths)
            sequences = max((r[3] + r[2] for r in runs), default=0)
            assert sequences <= serial(lengths, cap) + 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.packed_documents(df, K.default_tokenizer()).count() == 0


def test_pack_keeps_columns_of_any_name(spark):
    names = ["rank", "_part", "_at", "c0", "k0", "p", "i"]
    rows = [(i, 0, 0, 1 + i % 7, *[f"{n}{i}" for n in names], -1, -2) for i in range(40)]
    kinds = ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame(rows, f"doc_id long, piece int, start long, length long, {kinds}, sequence_id long, offset long")
    out = P.pack(df, 10)
    assert out.columns == [*df.columns[:-2], "sequence_id", "offset"]
    got = out.collect()
    assert sorted(tuple(r)[:-2] for r in got) == sorted(r[:-2] for r in rows)
    used = defaultdict(int)
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 10 and len(used) <= serial([r[3] for r in rows], 10) + 1
