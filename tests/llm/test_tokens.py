import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessel.llm import tokens as K
from tessel.llm.words import text_buffer

ODD = ["", "  ", "a", "<|endoftext|> x", "don't  I'LL\x1cgo\x85on now", "é ́x", "日本 語!!", "end. End, 's. It's; x!! ?! a.b é. <|ENDOFTEXT|>.", "İ Ǆ ﬁ. " + "long" * 30 + ".", " a\x0bb", "Ａ ﬁ"]


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(K.default_tokenizer())
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_words_encode_like_whole_texts(texts):
    encoder = K.WordEncoder.of_worker(K.default_tokenizer())
    for _ in range(2):  # unknown words, then known ones
        ids, first = encoder(*text_buffer(pa.array(texts + ODD)))
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == whole(texts + ODD)


def rows():
    out = [(5, "b b"), (3, None), (4, ""), (5, "a a"), (None, "no id"), (10, "The quick  brown " * 3000), (11, "tail")]
    return [(a, b, "x", 1) for a, b in out + [(5, "a a")]]


@pytest.mark.parametrize("length,batch", [(16, 4), (2048, 256)])
def test_round_trip_through_the_files(spark, length, batch):
    df = spark.createDataFrame(rows(), "doc_id long, text string, start string, n_tokens int")
    files, _ = K.write_sequences(df, K.default_tokenizer(), 1, length, batch)
    got = [tuple(r) for r in K.read_documents(spark, files).orderBy("start").collect()]
    want, at = [], 0
    for doc_id, text, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole([text or ""])[0] + [1]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    parts = files.orderBy("part").collect()
    flat = []
    for r in parts:
        f = K.SequenceFile(r.file)
        n = -(-r.n_tokens // length)
        for i in range(n):
            ids, mask = f.sequence(i)
            assert len(ids) == len(mask) == length and not ids.flags.owndata
            flat += ids[mask].tolist()
        with pytest.raises(IndexError):
            f.sequence(n)
    assert flat == [i for r in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")) for i in whole([r[1] or ""])[0] + [1]]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    files, _ = K.write_sequences(df, K.default_tokenizer(), 1)
    assert K.read_documents(spark, files).count() == 0


def test_word_table_grows_with_its_words():
    table = K.WordTable(np.dtype("<u2"))
    held = lambda: sum(x.nbytes for x in (table.keys, table.entry, table.ids, table.begin, table.size))
    assert held() < 2 << 20  # a few words take little
    rng, known = np.random.default_rng(4), {}
    for n in (10, 40_000, 200_000):
        h = np.unique(rng.integers(1, 1 << 63, n, np.uint64) << np.uint64(1))
        runs = [np.array([i % 60000] * (i % 3), "<u2").tobytes() for i in range(len(h))]
        entry = table.add(runs, 2)
        table.put(h, entry.astype(np.int32))
        known |= dict(zip(h.tolist(), zip(entry.tolist(), runs)))
        keys = np.array(list(known), np.uint64)
        found = table.find(keys)
        assert found.tolist() == [known[k][0] for k in keys.tolist()]
        assert (table.find(keys | np.uint64(1)) == -1).all()
    for e, run in list(known.values())[::997]:
        assert table.ids[table.begin[e] : table.begin[e] + table.size[e]].tobytes() == run


def test_more_words_than_slots_still_end(monkeypatch):
    monkeypatch.setattr(K, "SLOTS", 16)
    monkeypatch.setattr(K, "CACHED_WORDS", 50)
    encoder = K.WordEncoder(K.default_tokenizer())
    texts = [" ".join(f"w{i}x{k}." for i in range(40)) for k in range(6)]
    for _ in range(2):
        ids, first = encoder(*text_buffer(pa.array(texts + ODD)))
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == whole(texts + ODD)
