"""Phrase collocations by dynamic itemset counting.

Texts are split into pieces and words once; the words' hashes are written as a table in
``SHARDS`` shards.  The shards are scanned in a cycle, one each step, and phrases of all
lengths are counted interleaved:

* words are counted from the first step on;
* a phrase is activated in the step after both its subphrases (all words but the last, all
  but the first) have been found ``THRESHOLD`` times so far, and counted from there on;
* it stops after one full cycle, when every shard has been counted once, so its count is exact;
* the scans end when no phrase is active.

What a scan has to know is when a subphrase reached the threshold.  That is a table of
``SLOTS`` bytes for each length, the step at which the first phrase of a slot reached
it.  Phrases that share a slot may be activated early, never late, and each is still counted
for exactly one cycle, so the table's size, fixed whatever the data, changes the work but
never a count.  Scans add up in the task first.  Running counts (phrase hash, number) stay in
packed arrays in the shared folder, one set for each range of slots; a step shuffles its
counts and the arrays by that range, adds them up, and sends the bits of the slots that
have reached the threshold to the driver (``SLOTS / 8`` bytes a length).

Candidates then get their words back in one more scan (of a few folders, then of more, each
time for the candidates still without, so that a phrase all tasks hold is told by few), their best cut and the longer phrases
that hold them by joins on phrase hashes, and an exact integer score in 128-bit decimals
(counts up to 10^15).  The best of each language are cut down in parts of it before
they meet, and only their words are spelled out.  Words and phrases are told apart by
64-bit hashes.

Defined cases: a null text has no words; a null language is ``und``; repeated rows count
each; an empty table gives an empty result; other columns are ignored; a text of any length
is one row's work, a piece without an end is kept whole.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessel.llm.words import blocks_for, chunks, mix, text_buffer, words
from tessel.session import discard, materialize, release

SHARDS = 3
FOLDERS = 8  # folders of a shard
SLOTS = 1 << 22
THRESHOLD = 10
LONGEST = 3
TOP = 2000
HOLDS = 50  # percent of a phrase's places that a longer one must have to replace it
ROW_WORDS = 1024  # words of a row of the sharded table; a longer piece is one row
SLICE_WORDS = 1 << 20  # words handled at once
HELD = 1 << 21  # counts held by a task before they are added up
ROW_COUNTS = 1 << 17  # counts in a row of packed arrays
BUCKET_BYTES = 16 << 20  # bytes of text whose phrases are added up in one task
UNDEFINED = "und"
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_NEVER = 255


def _language_seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _extend(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and the word after it."""
    return mix(key * np.uint64(0x9E3779B97F4A7C15) + word, 31)


def _keys(seq: np.ndarray, seed: np.uint64, longest: int):
    """Hashes of the phrases of 1, 2, ... words that begin at each place of ``seq`` (0 ends a piece):
    ``[(places, hashes), ...]``."""
    at = np.flatnonzero(seq)
    key = mix(seq[at] ^ seed, 30)
    out = [(at, key)]
    for m in range(2, longest + 1):
        go = at + m - 1 < len(seq)
        go[go] = seq[at[go] + m - 1] != 0
        at, key = at[go], key[go]
        key = _extend(key, seq[at + m - 1])
        out.append((at, key))
    return out


def _gaps() -> tuple[np.ndarray, np.ndarray]:
    """Bytes between words, and those of them that end a piece."""
    gaps, ends = np.zeros(256, bool), np.zeros(256, bool)
    gaps[list(b" \t" + _BREAKS)] = True
    ends[list(_BREAKS)] = True
    return gaps, ends


def sharded_words(docs: DataFrame, shards: int) -> DataFrame:
    """``folder, lang, words, seq``: packed sequences of word hashes, 0 before each piece, and how many words;
    shard ``k`` is every folder that leaves ``k`` when divided by ``shards``."""

    def run(batches):
        gaps, ends = _gaps()
        turn = 0
        for batch in batches:
            for part in chunks(batch):
                data, offsets = text_buffer(part.column("text"))
                h, start, _, first = words(data, offsets, gaps)
                if not len(h):
                    continue
                h = np.maximum(h, np.uint64(1))
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                piece = np.cumsum(ends[data])[start] + doc  # differs where a break or another text lies between
                lang = np.array([UNDEFINED if x is None else x for x in part.column("lang").to_pylist()], object)
                names, code = np.unique(lang.astype(str), return_inverse=True)
                for k, name in enumerate(names.tolist()):
                    mine = np.flatnonzero(code[doc] == k)
                    if not len(mine):
                        continue
                    new = np.append(True, piece[mine][1:] != piece[mine][:-1])
                    seq = np.zeros(len(mine) + int(new.sum()), np.uint64)
                    seq[np.arange(len(mine)) + np.cumsum(new)] = h[mine]
                    begin = np.flatnonzero(seq == 0)  # rows are cut where pieces begin
                    want = np.searchsorted(begin, np.arange(0, len(seq), ROW_WORDS))
                    cut = np.unique(np.append(begin[np.minimum(want, len(begin) - 1)], len(seq)))
                    rows = [seq[x:y] for x, y in zip(cut, cut[1:])]
                    yield pa.record_batch(
                        {
                            "folder": pa.array((turn + np.arange(len(rows))) % (shards * FOLDERS), pa.int32()),
                            "lang": pa.array([name] * len(rows), pa.string()),
                            "words": pa.array([int(np.count_nonzero(r)) for r in rows], pa.int64()),
                            "seq": pa.array([r.tobytes() for r in rows], pa.binary()),
                        }
                    )
                    turn += len(rows)

    rows = docs.select("text", F.col("lang").cast("string").alias("lang"))
    return rows.mapInArrow(run, "folder int, lang string, words long, seq binary")


def _sequences(batch: pa.RecordBatch):
    """``(language, sequence)`` of a batch of rows, those of a language together, about ``SLICE_WORDS`` at a time."""
    lang = batch.column("lang").to_numpy(zero_copy_only=False).astype(str)
    seq, end = batch.column("seq"), np.zeros(1, np.uint64)
    for name in np.unique(lang).tolist():
        held, n = [], 0
        for i in np.flatnonzero(lang == name).tolist():
            held.append(np.frombuffer(seq[i].as_buffer(), np.uint64))
            n += len(held[-1])
            if n >= SLICE_WORDS:
                yield name, np.concatenate([*held, end])
                held, n = [], 0
        if held:
            yield name, np.concatenate([*held, end])  # every row begins with a 0


def _active(keys, reached: list[np.ndarray], slots: int, step: int, shards: int):
    """Of phrases of 1, 2, ... words those that a step counts: ``(length, hashes)``."""
    if step < shards:
        yield 1, keys[0][1]
    mask = np.uint64(slots - 1)
    for m in range(2, len(keys) + 1):
        at, key = keys[m - 1]
        before_at, before = keys[m - 2]
        since = reached[m - 2][(before & mask).astype(np.int64)].astype(np.int64)
        # all words but the last begin at the same place, all but the first one place on
        begins = np.maximum(since[np.searchsorted(before_at, at)], since[np.searchsorted(before_at, at + 1)]) + 1
        yield m, key[(begins <= step) & (step < begins + shards)]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up; keys ascending."""
    key, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key)
    key, n = key[order], n[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[new], np.add.reduceat(n, new) if len(new) else n


_PACKED = "bucket int, len int, keys binary, counts binary, bits binary"


def _pack(bucket: int, m: int, key: np.ndarray, n: np.ndarray, bits: bytes = b"") -> list[tuple]:
    rows = []
    for i in range(0, max(len(key), 1), ROW_COUNTS):
        rows.append((bucket, m, key[i : i + ROW_COUNTS].tobytes(), n[i : i + ROW_COUNTS].astype(np.int64).tobytes(), bits))
        bits = b""
    return rows


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "len", "keys", "counts", "bits"]
    )


def scan(table: DataFrame, shard: int, step: int, shards: int, reached: list[np.ndarray], slots: int, buckets: int) -> DataFrame:
    """Packed counts of the phrases active in a step, over one shard."""
    longest = len(reached) + 1

    def rows(m, key, n):
        bucket = (key & np.uint64(slots - 1)).astype(np.int64) * buckets // slots
        order = np.argsort(bucket, kind="stable")
        key, n = key[order], n[order]
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        return [r for b in range(buckets) if cut[b] < cut[b + 1] for r in _pack(b, m, key[cut[b] : cut[b + 1]], n[cut[b] : cut[b + 1]])]

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for lang, seq in _sequences(batch):
                for m, key in _active(_keys(seq, _language_seed(lang), longest), reached, slots, step, shards):
                    if len(key):
                        held.setdefault(m, []).append(np.unique(key, return_counts=True))
                for m, parts in held.items():
                    if sum(len(k) for k, _ in parts) > HELD:
                        held[m] = [_added(parts)]
                        if len(held[m][0][0]) > HELD // 2:
                            yield _packed_batch(rows(m, *held[m][0]))
                            held[m] = []
        for m, parts in held.items():
            if parts:
                yield _packed_batch(rows(m, *_added(parts)))

    return table.filter(F.col("folder") % shards == shard).select("lang", "seq").mapInArrow(run, _PACKED)


def _merge(slots: int, buckets: int, threshold: int):
    """Adds up the packed counts of every (bucket, length) and marks the slots that have reached the threshold."""

    def run(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for b, m, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "len", "keys", "counts"))):
                held.setdefault((b, m), []).append((np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64)))
        for (b, m), parts in held.items():
            key, n = _added(parts)
            low, high = -(-b * slots // buckets), -(-(b + 1) * slots // buckets)
            marks = np.zeros(high - low, bool)
            marks[(key[n >= threshold] & np.uint64(slots - 1)).astype(np.int64) - low] = True
            yield _packed_batch(_pack(b, m, key, n, np.packbits(marks).tobytes()))

    return run


def count_phrases(
    table: DataFrame, longest: int, threshold: int, shards: int, slots: int, buckets: int
) -> DataFrame:
    """``len, key, n``: every phrase of up to ``longest`` words found ``threshold`` times, and how often."""
    if slots & (slots - 1) or shards >= _NEVER // (longest + 1):
        raise ValueError("slots must be a power of two and shards a small number")
    spark, buckets = table.sparkSession, min(buckets, slots)
    reached = [np.full(slots, _NEVER, np.uint8) for _ in range(longest - 1)]
    running, ended, parts, step, old = None, set(), [], 0, None

    def unpack(batches):
        for batch in batches:
            for m, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("len", "keys", "counts"))):
                key, n = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int64)
                some = n >= threshold
                yield pa.record_batch(
                    {"len": pa.array(np.full(int(some.sum()), m), pa.int32()), "key": pa.array(key[some]), "n": pa.array(n[some])}
                )

    while len(ended) < longest:
        counts = scan(table, step % shards, step, shards, reached, slots, buckets)
        if running is not None:
            counts = counts.unionByName(running)
        added = counts.repartitionById(buckets, F.col("bucket")).mapInArrow(_merge(slots, buckets, threshold), _PACKED)
        running, path = materialize(added, "counts")
        found = running.filter((F.col("len") < longest) & (F.octet_length("bits") > 0)).select("bucket", "len", "bits")
        for r in found.collect():  # a bit for each slot of each length
            low, high = (-(-b * slots // buckets) for b in (r["bucket"], r["bucket"] + 1))
            at = low + np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=high - low))
            seen = reached[r["len"] - 1]
            seen[at[seen[at] == _NEVER]] = step
        step += 1
        live = {1} if step < shards else set()
        for m in range(2, longest + 1):
            steps = np.unique(reached[m - 2]).astype(np.int64)
            if ((steps != _NEVER) & (steps + 1 <= step) & (step < steps + 1 + shards)).any():
                live.add(m)
        # a length has ended when no shorter one can activate more of it
        now = {m for m in range(1, longest + 1) if not live & set(range(1, m + 1))} - ended
        if now:
            done = running.filter(F.col("len").isin(list(now))).select("len", "keys", "counts")
            parts.append(materialize(done.mapInArrow(unpack, "len int, key long, n long"), "counted")[0])
            ended |= now
            running = running.filter(~F.col("len").isin(list(ended)))
        if old:
            discard(spark, old)
        old = path
        release(spark)
    discard(spark, old)
    out = parts[0]
    for some in parts[1:]:
        out = out.unionByName(some)
    return out


_PLACES = (0, 21, 42)  # bits of a hash at which its three slots begin


def _marks(hashes: DataFrame, slots: int) -> list[np.ndarray]:
    """Three tables of the slots that the ``key`` column takes (a hash is looked up in all three): one word
    of bits for 64 slots comes back, so at most ``3 * slots / 64`` rows."""
    marks = [np.zeros(max(slots, 64), bool) for _ in _PLACES]
    slot = lambda b: F.shiftrightunsigned("key", b).bitwiseAND(F.lit(slots - 1))
    each = F.array(*(F.struct(F.lit(t).alias("t"), slot(b).alias("slot")) for t, b in enumerate(_PLACES)))
    bits = hashes.select(F.inline(each))
    bits = bits.select("t", F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    for r in bits.groupBy("t", "word").agg(F.bit_or("bit").alias("bits")).collect():
        found = np.unpackbits(np.array([r["bits"]], "<i8").view(np.uint8), bitorder="little")
        marks[r["t"]][64 * r["word"] : 64 * r["word"] + 64] = found
    return marks


def _marked(marks: list[np.ndarray], slots: int, key: np.ndarray) -> np.ndarray:
    """Places of the hashes that are marked, and perhaps of a few others."""
    at = np.arange(len(key))
    for mark, b in zip(marks, _PLACES):
        at = at[mark[((key[at] >> np.uint64(b)) & np.uint64(slots - 1)).astype(np.int64)]]
    return at


def _spans(m: int) -> list[tuple[int, int]]:
    """``(from, to)`` of the contiguous parts of ``m`` words."""
    return [(a, b) for a in range(m) for b in range(a + 1, m + 1) if b - a < m]


def _untold(told: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the distinct ``one`` a task has not told yet, and what it has told then (some, if it is too much)."""
    new = ~np.isin(one, told)
    return new, np.union1d(told, one[new]) if len(told) < HELD else told


def _tell(table: DataFrame, marks: list[np.ndarray], longest: int, slots: int) -> DataFrame:
    """``key, len, lang, hashes, parts`` of the phrases of two or more words in marked slots."""

    def run(batches):
        told = [np.zeros(0, np.uint64)] * (longest + 1)
        for batch in batches:
            for lang, seq in _sequences(batch):
                keys = _keys(seq, _language_seed(lang), longest)
                for m in range(2, longest + 1):
                    at, key = keys[m - 1]
                    some = _marked(marks, slots, key)
                    one, first = np.unique(key[some], return_index=True)
                    new, told[m] = _untold(told[m], one)
                    if not new.any():
                        continue
                    at, key = at[some[first[new]]], one[new]
                    hashes = seq[at[:, None] + np.arange(m)]
                    inner = [keys[b - a - 1][1][np.searchsorted(keys[b - a - 1][0], at + a)] for a, b in _spans(m)]
                    lists = lambda x: pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel().view(np.int64))
                    )
                    yield pa.record_batch(
                        {
                            "key": pa.array(key.view(np.int64)),
                            "len": pa.array(np.full(len(key), m), pa.int32()),
                            "lang": pa.array([lang] * len(key)),
                            "hashes": lists(hashes),
                            "parts": lists(np.stack(inner, 1)),
                        }
                    )

    rows = table.select("lang", "seq")
    return rows.mapInArrow(run, "key long, len int, lang string, hashes array<long>, parts array<long>")


def phrase_words(table: DataFrame, counted: DataFrame, longest: int, slots: int, folders: int) -> DataFrame:
    """``key, a, len, lang, hashes, parts``: every phrase of two or more that was counted, how often, its
    words, and the hashes of its contiguous parts in the order of ``_spans``."""
    spark = table.sparkSession
    missing = counted.filter("len > 1").select("key", F.col("n").alias("a"))
    out, at, size, old = None, 0, 1, None
    while out is None or at < folders:
        marks = _marks(missing.select("key"), slots)
        if out is not None and not marks[0].any():
            break
        some = table.filter((F.col("folder") >= at) & (F.col("folder") < at + size))
        told = _tell(some, marks, longest, slots).dropDuplicates(["key"])
        found, _ = materialize(missing.join(told, "key"), "phrases")
        out = found if out is None else out.unionByName(found)
        missing, path = materialize(missing.join(found.select("key"), "key", "left_anti"), "missing")
        if old:
            discard(spark, old)
        at, old = at + size, path
        size = at  # as many again: 1, 1, 2, 4, ... folders
        release(spark)
    return out


def spelled(docs: DataFrame, hashes: DataFrame, slots: int) -> DataFrame:
    """``key, word``: the words (A-Z lower-cased) with the hashes ``key``, and perhaps others."""
    marks = _marks(hashes, slots)

    def run(batches):
        gaps, _ = _gaps()
        upper, told = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.zeros(0, np.uint64)
        table = str.maketrans(upper, upper.lower())
        for batch in batches:
            for part in chunks(batch):
                data, offsets = text_buffer(part.column("text"))
                h, start, end, _ = words(data, offsets, gaps)
                h = np.maximum(h, np.uint64(1))
                some = _marked(marks, slots, h)
                one, first = np.unique(h[some], return_index=True)
                new, told = _untold(told, one)
                at = some[first[new]]
                found = [bytes(data[a:b]).decode().translate(table) for a, b in zip(start[at], end[at])]
                yield pa.record_batch({"key": pa.array(one[new].view(np.int64)), "word": pa.array(found, pa.string())})

    return docs.select("text").mapInArrow(run, "key long, word string").groupBy("key").agg(F.min("word").alias("word"))


def _scored(candidates: DataFrame, counted: DataFrame, longest: int) -> DataFrame:
    """``candidates`` with ``l, r, score`` of the lowest-scoring cut."""
    counts = counted.select(F.col("key").alias("part"), F.col("n").alias("f"))
    asked = candidates.select("key", "parts", F.posexplode("parts").alias("place", "part"))
    found = asked.join(counts, "part").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("place", "f"))).alias("f"))
    rows = candidates.join(found, "key")
    wide = lambda c: c.cast("decimal(16,0)")

    def cuts(m: int) -> Column:
        spans = _spans(m)
        out = []
        for k in range(1, m):
            left, right = (F.element_at("f", F.lit(spans.index(s))) for s in ((0, k), (k, m)))
            rows_of = F.struct(left.alias("l"), right.alias("r"), F.lit(k).alias("k"))
            out.append(rows_of)
        return F.array(*out)

    by_length = F.when(F.col("len") == 2, cuts(2))
    for m in range(3, longest + 1):
        by_length = by_length.when(F.col("len") == m, cuts(m))
    rows = rows.withColumn("cuts", by_length)
    # floor(10^6 a a / (l r)) in 128-bit integers
    rows = rows.withColumn("top", wide(F.col("a")) * wide(F.col("a")) * F.lit(1_000_000).cast("decimal(7,0)"))
    score = "transform(cuts, c -> struct(top DIV (CAST(c.l AS DECIMAL(16,0)) * CAST(c.r AS DECIMAL(16,0))) AS score, c.k AS k, c.l AS l, c.r AS r))"
    rows = rows.withColumn("cut", F.array_min(F.expr(score)))
    return rows.select(*candidates.columns, F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def collocations(
    docs: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, top: int = TOP, holds: int = HOLDS,
    shards: int = SHARDS, slots: int = SLOTS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``longest`` words."""
    buckets = blocks_for(docs, "text", BUCKET_BYTES)
    # in folders, so a scan reads its shard and no other
    table, _ = materialize(sharded_words(docs, shards), "words", partition_by="folder")
    counted = count_phrases(table, longest, threshold, shards, slots, buckets)
    phrases = phrase_words(table, counted, longest, slots, shards * FOLDERS)
    # a phrase goes where a longer one that holds it has enough of its places
    inside = phrases.filter("len > 2").select(F.explode("parts").alias("key"), F.col("a").alias("longer"))
    most = inside.groupBy("key").agg(F.max("longer").alias("longer"))
    kept = phrases.join(most, "key", "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < holds * F.col("a"))
    )
    scored = _scored(kept.drop("longer"), counted, longest)
    # ties at the end of the list are told apart by their words, so all of them stay until these are known
    # in two steps: the best of many parts of a language, then of these, each group about as large
    parts = max(1, math.isqrt(phrases.count() // max(top, 1)))
    by = F.col("score").desc(), F.col("a").desc()
    first = scored
    for group in ([F.col("lang"), F.pmod("key", F.lit(parts))], [F.col("lang")])[parts == 1 :]:
        first = first.withColumn("_r", F.rank().over(Window.partitionBy(*group).orderBy(*by))).filter(F.col("_r") <= top).drop("_r")
    first, _ = materialize(first, "best")
    asked = first.select(F.col("key").alias("phrase_key"), F.posexplode("hashes").alias("place", "key"))
    texts = asked.join(spelled(docs, asked.select("key"), slots), "key").groupBy("phrase_key")
    texts = texts.agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w"))
    texts = texts.select(F.col("phrase_key").alias("key"), F.array_join(F.col("w.word"), " ").alias("phrase"))
    sizes = table.groupBy("lang").agg(F.sum("words").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = first.join(texts, "key").join(sizes, "lang")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def oracle_sql() -> str:
    """``collocations`` of ``documents`` as DuckDB SQL: every phrase of up to three words counted."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        f"WITH p AS (SELECT coalesce(lang, '{UNDEFINED}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), "
        f"'{upper}', '{upper.lower()}'), " r"'[.,;:!?\x0A-\x0D]')) AS piece FROM documents), "
        r"s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p), "
        "i AS (SELECT lang, row_number() OVER () AS p, w FROM s WHERE len(w) > 0), "
        "o AS (SELECT lang, p, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM i), "
        "u AS (SELECT lang, x, lead(x, 1) OVER v AS y, lead(x, 2) OVER v AS z FROM o WINDOW v AS (PARTITION BY p ORDER BY k)), "
        "f1 AS (SELECT lang, x, count(*) AS f FROM u GROUP BY ALL), "
        "f2 AS (SELECT lang, x, y, count(*) AS f FROM u WHERE y IS NOT NULL GROUP BY ALL), "
        "f3 AS (SELECT lang, x, y, z, count(*) AS f FROM u WHERE z IS NOT NULL GROUP BY ALL), "
        "n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY ALL), "
        f"c AS (SELECT f2.lang, x || ' ' || y AS phrase, f2.f AS a, 1 AS k, b.f AS l, e.f AS r FROM f2 "
        f"JOIN f1 b USING (lang, x) JOIN f1 e ON e.lang = f2.lang AND e.x = y WHERE f2.f >= {THRESHOLD} "
        "UNION ALL SELECT f3.lang, x || ' ' || f3.y || ' ' || z, f3.f, 1, b.f, e.f FROM f3 JOIN f1 b USING (lang, x) "
        f"JOIN f2 e ON e.lang = f3.lang AND e.x = f3.y AND e.y = f3.z WHERE f3.f >= {THRESHOLD} "
        "UNION ALL SELECT f3.lang, x || ' ' || y || ' ' || z, f3.f, 2, b.f, e.f FROM f3 JOIN f2 b USING (lang, x, y) "
        f"JOIN f1 e ON e.lang = f3.lang AND e.x = f3.z WHERE f3.f >= {THRESHOLD}), "
        "b AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM c "
        "QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (1000000::HUGEINT * a * a) // (l::HUGEINT * r), k) = 1), "
        "h AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, x || ' ' || y AS phrase, f FROM f3 "
        f"WHERE f >= {THRESHOLD} UNION ALL SELECT lang, y || ' ' || z, f FROM f3 WHERE f >= {THRESHOLD}) GROUP BY ALL), "
        f"e AS (SELECT b.* FROM b LEFT JOIN h USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {HOLDS} * a), "
        "z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e) "
        "SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score "
        f"FROM z JOIN n USING (lang) WHERE rank <= {TOP}"
    )
