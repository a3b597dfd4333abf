"""Language-model scoring by prediction by partial matching over byte contexts.

The trie holds, for every context of up to four bytes seen in the training texts,
the counts of the byte (or end of text) that followed.  A symbol is predicted in
the longest context; where the context has not seen it, the model pays the escape
(method C: distinct symbols against occurrences), drops to the next shorter
context and excludes the symbols the longer one had, down to order 0 and then to
the symbols never seen.  A text's score is the sum of the log10 probabilities of
its bytes and its end.

A prediction depends on five consecutive symbols only, so scoring is a join
between the texts' distinct five-symbol strings and the trie:

1.  texts are dealt to blocks; a block task sorts its strings, counts those of its
    training texts, and sends one packed array to each part (a part owns all
    strings whose last two context bytes hash to it, hence every context of order
    two to four whole);
2.  a part task adds up the blocks' counts - its share of the trie - computes the
    prediction of every requested string, and answers each block with one array;
3.  a block task adds up its texts' predictions.

Word counts for the smoothed unigram base travel the same way, keyed by 64-bit word
hashes.  Counts cover every training text; what is gathered grows with the input,
and no task holds more than a block's distinct strings or a part's share of all.
Orders zero and one are one table of at most 257 x 257 counts, known to every task.

Defined cases: a null text is empty and has its end only; a null ``doc_id`` hashes
as empty text for the split; repeated rows count and are scored each; without
training texts every symbol has probability 1 / 257; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.words import chunks, text_buffer, words

ORDER = 4
END = 256  # end of text, also the context before its first byte
SYMBOLS = 257
BITS = 9
BLOCK_BYTES = 32 << 20
MAX_BLOCKS = 4096  # packed arrays number blocks x parts; larger inputs get larger blocks
END_WORD = np.uint64(0xFFFFFFFFFFFFFFFF)
_U = np.uint64


def strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ``ORDER + 1`` symbols ending at each byte and at the end of each text, and
    the number of codes of each text."""
    size = np.diff(offsets)
    gap = ORDER + 1
    x = np.full(int(offsets[-1]) + gap * len(size) + ORDER, END, np.uint64)
    valid = np.zeros(len(x) - ORDER, bool)
    for i, (a, n) in enumerate(zip(offsets[:-1].tolist(), size.tolist())):
        at = a + gap * i + ORDER
        x[at : at + n] = data[a : a + n]
        valid[at - ORDER : at + n + 1 - ORDER] = True
    code = x[: len(x) - ORDER].copy()
    for k in range(1, ORDER + 1):
        code <<= _U(BITS)
        code |= x[k : len(x) - ORDER + k]
    return code[valid], size + 1


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    if not len(k):
        return k, c.astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[at], np.add.reduceat(c, at)


def _runs(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an array (sorted in place) and how often each stands."""
    packed.sort()
    at = np.flatnonzero(np.append(True, packed[1:] != packed[:-1])) if len(packed) else np.zeros(0, np.int64)
    return packed[at], np.diff(np.append(at, len(packed)))


def _context_sums(gram: np.ndarray, n: np.ndarray):
    """Per context of ``gram`` (its code without the last symbol): contexts, row of each gram,
    occurrences, distinct symbols."""
    context = gram >> _U(BITS)
    at = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(gram) else np.zeros(0, np.int64)
    row = np.cumsum(np.append(True, context[1:] != context[:-1])[: len(gram)]) - 1
    total = np.bincount(row, n, minlength=len(at))
    kinds = np.bincount(row, n > 0, minlength=len(at))
    return row, total, kinds


def predictions(gram: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of each string's last symbol.

    ``gram`` are sorted codes holding every training string of their contexts of order two and
    more, ``n`` their counts, ``pairs`` the 257 x 257 counts of (previous symbol, symbol).
    """
    # counts of every order for each string, from the longest down
    grams, counts = [gram], [n.astype(np.float64)]
    index = []  # position of each string of one order among those of the next shorter
    for order in range(ORDER, 2, -1):
        mask = _U((1 << (BITS * order)) - 1)
        shorter, back = np.unique(grams[-1] & mask, return_inverse=True)
        index.append(back)
        counts.append(np.bincount(back, counts[-1], minlength=len(shorter)))
        grams.append(shorter)
    two = grams[-1]  # order two: (c3, c4, symbol)
    pair = (two & _U((1 << (2 * BITS)) - 1)).astype(np.int64)
    before, symbol = pair >> BITS, pair & ((1 << BITS) - 1)
    ones = pairs.astype(np.float64)
    zeros = ones.sum(axis=0)
    n1, n0 = ones[before, symbol], zeros[symbol]
    # below order two, for each (c3, c4, symbol): mass and kinds left after exclusion
    row2, total2, kinds2 = _context_sums(two, counts[-1])
    seen2 = counts[-1] > 0
    out1 = np.bincount(row2, np.where(seen2, n1, 0), minlength=len(total2))  # order-1 mass order 2 has seen
    c4 = np.zeros(len(total2), np.int64)
    c4[row2] = before
    left1, left1_kinds = ones.sum(axis=1)[c4] - out1, (ones > 0).sum(axis=1)[c4] - kinds2
    seen1 = ones > 0
    left0 = zeros.sum() - (seen1 * zeros).sum(axis=1)
    left0_kinds = (zeros > 0).sum() - seen1.sum(axis=1)
    unseen = SYMBOLS - int((zeros > 0).sum())

    def escape(mass, kinds):
        return np.where(kinds > 0, kinds / np.maximum(mass + kinds, 1), 1.0)

    with np.errstate(divide="ignore", invalid="ignore"):
        p0 = np.where(n0 > 0, n0 / (left0 + left0_kinds)[before], escape(left0, left0_kinds)[before] / max(unseen, 1))
        p = np.where(
            n1 > 0, n1 / (left1 + left1_kinds)[row2], escape(left1, left1_kinds)[row2] * p0
        )  # probability after escaping from order two
        # back up: at every order either the symbol was seen there or it escapes to `p`
        level_rows = [_context_sums(g, c) for g, c in zip(grams, counts)]
        for level in range(len(grams) - 1, -1, -1):
            row, total, kinds = level_rows[level]
            c = counts[level]
            if level == 0:
                mass, left = total, kinds
                here = np.where(c > 0, c / (mass + left)[row], escape(mass, left)[row] * p)
                return np.log10(here)
            # exclusion by the next longer order: its contexts' symbols leave mass and kinds
            longer = level - 1
            back = index[longer]
            row_l, _, kinds_l = level_rows[longer]
            out = np.bincount(row_l, np.where(counts[longer] > 0, c[back], 0), minlength=len(kinds_l))
            shorter_row = np.zeros(len(kinds_l), np.int64)
            shorter_row[row_l] = row[back]
            mass, left = total[shorter_row] - out, kinds[shorter_row] - kinds_l
            cs = c[back]
            p = np.where(cs > 0, cs / (mass + left)[row_l], escape(mass, left)[row_l] * p[back])
    raise AssertionError


def pair_counts(docs: DataFrame) -> np.ndarray:
    """257 x 257 counts of (previous symbol, symbol) over ``docs(text)``; at most that many rows return."""

    def run(batches):
        total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in batches:
            for part in chunks(batch):
                data, offsets = text_buffer(part.column("text"))
                size = np.diff(offsets)
                some = offsets[:-1][size > 0]
                inner = data[:-1].astype(np.int32) * SYMBOLS + data[1:] if len(data) else np.zeros(0, np.int32)
                keep = np.ones(len(inner), bool)
                keep[some[some > 0] - 1] = False
                total += np.bincount(inner[keep], minlength=len(total))
                total += np.bincount(END * SYMBOLS + data[some].astype(np.int64), minlength=len(total))
                last = offsets[1:][size > 0] - 1
                total += np.bincount(data[last].astype(np.int64) * SYMBOLS + END, minlength=len(total))
                total[END * SYMBOLS + END] += int((size == 0).sum())
        at = np.flatnonzero(total)
        yield pa.record_batch({"pair": pa.array(at), "n": pa.array(total[at])})

    found = docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for r in found:
        out[r["pair"]] = r["n"]
    return out.reshape(SYMBOLS, SYMBOLS)


def _part_of(keys: np.ndarray, parts: int, grams: bool) -> np.ndarray:
    own = (keys >> _U(BITS)) & _U((1 << (2 * BITS)) - 1) if grams else keys
    own = (own + _U(1)) * _U(0x9E3779B97F4A7C15)
    return ((own >> _U(33)) % _U(parts)).astype(np.int64)


def _count_block(parts: int):
    """Stage 1: one row for each part with the block's strings and words and their training counts."""

    def run(batches):
        block, grams, gram_n, hashes, hash_n, docs = None, [], [], [], [], 0
        for batch in batches:
            if batch.num_rows:
                block = batch.column("block")[0].as_py()
            for part in chunks(batch):
                train = part.column("train").to_numpy(zero_copy_only=False)
                data, offsets = text_buffer(part.column("text"))
                code, size = strings(data, offsets)
                packed, n = _runs(code << _U(1) | np.repeat(train, size).astype(np.uint64))
                grams.append(packed >> _U(1))
                gram_n.append(n * (packed & _U(1)).astype(np.int64))
                h, _, _, first = words(data, offsets)
                here = np.repeat(train, np.diff(first))
                for flag in (True, False):
                    k, n = _runs(h[here == flag])
                    hashes.append(k)
                    hash_n.append(n * flag)
                docs += int(train.sum())
                if len(grams) >= 8:  # keep what is held near the distinct strings
                    grams, gram_n = ([x] for x in add_up(grams, gram_n))
                    hashes, hash_n = ([x] for x in add_up(hashes, hash_n))
        if block is None:
            return
        hashes.append(np.array([END_WORD]))
        hash_n.append(np.array([docs]))
        packed = []
        for kind, (k, n) in ((True, add_up(grams, gram_n)), (False, add_up(hashes, hash_n))):
            owner = _part_of(k, parts, kind)
            order = np.argsort(owner, kind="stable")
            k, n = k[order], n[order]
            cut = np.searchsorted(owner[order], np.arange(parts + 1))
            packed.append([(k[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(cut, cut[1:])])
        for q in range(parts):
            (g, gn), (w, wn) = packed[0][q], packed[1][q]
            yield pa.record_batch(
                {
                    "part": pa.array([q], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "grams": pa.array([g], pa.binary()),
                    "gram_n": pa.array([gn], pa.binary()),
                    "words": pa.array([w], pa.binary()),
                    "word_n": pa.array([wn], pa.binary()),
                }
            )

    return run


def _answer(pairs: np.ndarray):
    """Stage 2: a part's share of the trie, and one answer for each block."""

    def run(batches):
        rows = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "grams", "gram_n", "words", "word_n"))
            rows.extend(zip(*columns))
        if not rows:
            return
        read = lambda i, kind: [np.frombuffer(r[i], kind) for r in rows]
        asked, asked_words = read(1, np.uint64), read(3, np.uint64)
        gram, n = add_up(asked, read(2, np.int64))
        value = predictions(gram, n, pairs).astype(np.float32)
        word, word_n = add_up(asked_words, read(4, np.int64))
        total, kinds = int(word_n.sum()), int((word_n > 0).sum())
        for row, g, w in zip(rows, asked, asked_words):
            yield pa.record_batch(
                {
                    "block": pa.array([row[0]], pa.int32()),
                    "grams": pa.array([row[1]], pa.binary()),
                    "log_p": pa.array([value[np.searchsorted(gram, g)].tobytes()], pa.binary()),
                    "words": pa.array([row[3]], pa.binary()),
                    "word_n": pa.array([word_n[np.searchsorted(word, w)].tobytes()], pa.binary()),
                    "tokens": pa.array([total], pa.int64()),
                    "kinds": pa.array([kinds], pa.int64()),
                }
            )

    return run


def _score_block(batches):
    """Stage 3: the answers come first, then the block's texts."""
    answers, model = [], None
    for batch in batches:
        is_text = batch.column("is_text").to_numpy(zero_copy_only=False)
        n = int(np.searchsorted(is_text, True))
        if n:
            head = batch.slice(0, n)
            names = ("grams", "log_p", "words", "word_n", "tokens", "kinds")
            answers.extend(zip(*(head.column(c).to_pylist() for c in names)))
        batch = batch.slice(n)
        if not batch.num_rows:
            continue
        if model is None:

            def joined(i, j, kind):
                k = np.concatenate([np.frombuffer(a[i], np.uint64) for a in answers])
                v = np.concatenate([np.frombuffer(a[j], kind) for a in answers])
                order = np.argsort(k)
                return k[order], v[order]

            gram, log_p = joined(0, 1, np.float32)
            word, word_n = joined(2, 3, np.int64)
            tokens, kinds = sum(a[4] for a in answers), sum(a[5] for a in answers)
            log_n = np.log10(word_n + 1.0)
            end = int(np.searchsorted(word, END_WORD))
            model = answers = True
        for part in chunks(batch):
            data, offsets = text_buffer(part.column("text"))
            n_docs = part.num_rows
            code, size = strings(data, offsets)
            shift = _U(64 - BITS * (ORDER + 1))  # the text's number fits beside a string's code
            packed, times = _runs(code << shift | np.repeat(np.arange(n_docs, dtype=np.uint64), size))
            doc = (packed & ((_U(1) << shift) - _U(1))).astype(np.int64)
            value = log_p[np.searchsorted(gram, packed >> shift)]
            score = np.bincount(doc, times * value.astype(np.float64), minlength=n_docs)
            h, _, _, first = words(data, offsets)
            at = np.searchsorted(word, h)
            owner = np.repeat(np.arange(n_docs), np.diff(first))
            n_tokens = np.diff(first) + 1
            known = np.bincount(owner, word_n[at] > 0, minlength=n_docs) + (word_n[end] > 0)
            logs = np.bincount(owner, log_n[at], minlength=n_docs) + log_n[end]
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "held_out": pa.array(~part.column("train").to_numpy(zero_copy_only=False)),
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                    "n_known": pa.array(known.astype(np.int64)),
                    "train_tokens": pa.array(np.full(n_docs, tokens), pa.int64()),
                    "base_score": pa.array(logs - n_tokens * np.log10(tokens + kinds + 1.0)),
                    "score": pa.array(score),
                    "bits_per_byte": pa.array(-score / np.log10(2) / np.maximum(np.diff(offsets), 1)),
                }
            )


def score(docs: DataFrame, train: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every row of ``docs(doc_id, text)``, learning from the rows where ``train`` is true.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = min(MAX_BLOCKS, max(-(-total // block_bytes), min(fewest, 1 + (total >> 21))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(blocks)).cast("int"))
    pairs = pair_counts(rows.filter("train"))
    counted = rows.repartitionById(blocks, F.col("block")).mapInArrow(
        _count_block(blocks),
        "part int, block int, grams binary, gram_n binary, words binary, word_n binary",
    )
    answers = counted.repartitionById(blocks, F.col("part")).mapInArrow(
        _answer(pairs),
        "block int, grams binary, log_p binary, words binary, word_n binary, tokens long, kinds long",
    )
    both = rows.withColumn("is_text", F.lit(True)).unionByName(
        answers.withColumn("is_text", F.lit(False)), allowMissingColumns=True
    )
    dealt = both.repartitionById(blocks, F.col("block")).sortWithinPartitions("is_text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(
        _score_block,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, bits_per_byte double",
    )
