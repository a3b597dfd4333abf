"""Token ids of whole texts with a public tokenizer file, and the Arrow sequence files.

``WordEncoder`` encodes white-space separated words once each and joins their ids.
That equals encoding the whole text for tokenizers whose pre-tokenizer drops white
space (no piece and no normalisation then reaches across it), which is what makes
whole corpora affordable; ``by_words=False`` encodes every text as one string.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm.words import chunks, text_buffer, words, worker_store
from tessel.session import ensure_checkpoint_dir, materialize

CACHED_WORDS = 500_000  # words remembered by one worker; it starts anew beyond that
SLOTS = 1 << 16  # of an empty table, which doubles before it is half full
CACHED_BYTES = 48  # longer words are encoded each time
TEXT_BYTES = 2 << 20  # text encoded at once
TAILS = b".,;:!?"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTable:
    """Known words of a worker: 64-bit word hash -> run of ids, in flat arrays with open addressing."""

    def __init__(self, dtype):
        self.keys = np.zeros(SLOTS, np.uint64)
        self.entry = np.full(SLOTS, -1, np.int32)
        self.ids = np.zeros(1 << 16, dtype)
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.entries, self.used, self.stored = 0, 0, 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where unknown."""
        out = np.full(len(h), -1, np.int32)
        left = np.arange(len(h))
        slots = len(self.keys)
        slot = (h & np.uint64(slots - 1)).astype(np.int64)
        while len(left):
            e = self.entry[slot]
            hit = (e >= 0) & (self.keys[slot] == h[left])
            out[left[hit]] = e[hit]
            on = (e >= 0) & ~hit
            left, slot = left[on], (slot[on] + 1) % slots
        return out

    def add(self, runs: list[bytes], itemsize: int) -> np.ndarray:
        """New entries for runs of ids -> their numbers."""
        size = np.array([len(r) // itemsize for r in runs], np.int32)
        flat = np.frombuffer(b"".join(runs), self.ids.dtype)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.entries + len(runs) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.ids[self.used : self.used + len(flat)] = flat
        new = np.arange(self.entries, self.entries + len(runs))
        self.size[new] = size
        self.begin[new] = self.used + np.cumsum(size, dtype=np.int64) - size
        self.used += len(flat)
        self.entries += len(runs)
        return new

    def put(self, h: np.ndarray, entry: np.ndarray) -> None:
        """Store distinct, so far unknown hashes."""
        self.stored += len(h)
        slots = len(self.keys)
        if 2 * self.stored > slots:
            old = self.entry >= 0
            h, entry = np.concatenate([self.keys[old], h]), np.concatenate([self.entry[old], entry])
            while 2 * self.stored > slots:
                slots *= 2
            self.keys, self.entry = np.zeros(slots, np.uint64), np.full(slots, -1, np.int32)
        slot = (h & np.uint64(slots - 1)).astype(np.int64)
        while len(h):
            free = np.flatnonzero(self.entry[slot] < 0)
            at, who = np.unique(slot[free], return_index=True)  # one claim for each free slot
            won = free[who]
            self.entry[at], self.keys[at] = entry[won], h[won]
            lost = np.ones(len(h), bool)
            lost[won] = False
            h, entry, slot = h[lost], entry[lost], slot[lost]
            slot = np.where(self.entry[slot] < 0, slot, (slot + 1) % slots)


class WordEncoder:
    """Batches of texts -> ids, through a table of known words."""

    def __init__(self, path: str, by_words: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.by_words = by_words
        probe = ["Ab Cd", "ab cd"]
        self.lower = len(set(self._encode(probe))) == 1
        self._forget()

    def _forget(self) -> None:
        self.table = WordTable(self.dtype)
        tails = [b""] + [TAILS[i : i + 1] for i in range(len(TAILS))]
        found = self.table.add(self._encode([t.decode() for t in tails]), self.dtype.itemsize)
        self.tail = np.full(256, found[0])  # entry of the piece after a word, the empty one for a gap
        self.tail[list(TAILS)] = found[1:]

    @classmethod
    def of_worker(cls, path: str, by_words: bool = True) -> WordEncoder:
        """The worker's own instance, kept between tasks."""
        store = worker_store()
        if (path, by_words) not in store:
            store[path, by_words] = cls(path, by_words)
        return store[path, by_words]

    def _encode(self, strings: list[str]) -> list[bytes]:
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        out = []
        for at in range(0, len(strings), 4096):
            found = run(strings[at : at + 4096], add_special_tokens=False)
            out.extend(np.array(x.ids, self.dtype).tobytes() for x in found)
        return out

    def _encode_words(self, strings: list[str]) -> list[bytes]:
        """Words of letters go many in one string, cut again at the pre-tokenizer's pieces."""
        out: list[bytes] = [b""] * len(strings)
        plain = [i for i, w in enumerate(strings) if w.isalpha()]
        other = [i for i, w in enumerate(strings) if not w.isalpha()]
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            found = self.tokenizer.encode(" ".join([strings[i] for i in some]), add_special_tokens=False)
            begin = np.flatnonzero(np.diff(np.array(found.word_ids, np.int64), prepend=-1))
            if len(begin) != len(some):  # a word was more than one piece, or none
                other.extend(some)
                continue
            raw, size = np.array(found.ids, self.dtype).tobytes(), self.dtype.itemsize
            cuts = [*(begin * size).tolist(), len(raw)]
            for i, a, b in zip(some, cuts, cuts[1:]):
                out[i] = raw[a:b]
        for i, run in zip(other, self._encode([strings[i] for i in other])):
            out[i] = run
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text buffer and offsets -> ``(ids, first)``: text ``i`` has ``ids[first[i]:first[i + 1]]``."""
        raw = data.tobytes()
        if not self.by_words:
            runs = self._encode([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
            ids = np.frombuffer(b"".join(runs), self.dtype)
            return ids, np.cumsum([0] + [len(r) // self.dtype.itemsize for r in runs])
        if self.table.entries > CACHED_WORDS:
            self._forget()
        # A-Z counts as lower case for a lower-casing tokenizer, but not in names of added tokens
        lower = self.lower and b"<|" not in raw
        raw = raw.lower() if lower else raw
        h, start, end, first = words(data, offsets, lower=lower, trim=TAILS)
        known = self.table.find(h)
        missing = np.flatnonzero(known < 0)
        if len(missing):
            distinct, at, back = np.unique(h[missing], return_index=True, return_inverse=True)
            spans = zip(start[missing[at]].tolist(), end[missing[at]].tolist())
            runs = self._encode_words([raw[a:b].decode() for a, b in spans])
            entry = self.table.add(runs, self.dtype.itemsize)
            known[missing] = entry[back]
            short = (end - start)[missing[at]] <= CACHED_BYTES
            self.table.put(distinct[short], entry[short].astype(np.int32))
        after = self.tail[data[np.minimum(end, len(data) - 1)]]
        at_edge = np.zeros(len(data) + 1, bool)
        at_edge[offsets] = True
        after[at_edge[end]] = self.tail[32]  # a word at the end of its text has nothing after it
        entries = np.stack([known.astype(np.int64), after], axis=1).ravel()
        size = self.table.size[entries]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = self.table.ids[np.repeat(self.table.begin[entries] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[2 * first]


def encoded(batches, path: str, by_words: bool = True, end_id: int | None = None):
    """``(doc_id arrow array, ids, first, dtype)`` for runs of rows of bounded text."""
    encoder = WordEncoder.of_worker(path, by_words)
    for batch in batches:
        for part in chunks(batch, limit=TEXT_BYTES):
            ids, first = encoder(*text_buffer(part.column("text")))
            if end_id is not None:
                ids = np.insert(ids, first[1:], end_id)
                first = first + np.arange(len(first))
            yield part.column("doc_id"), ids, first, encoder.dtype


# ------------------------------------------------------------------ sequence files


def filesystem(uri: str):
    """``(pyarrow filesystem, path)`` of a folder named the way Spark names it."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(uri)


def _schema(length: int, dtype) -> pa.Schema:
    end = pa.struct([("doc_id", pa.int64()), ("stop", pa.int32())])
    return pa.schema(
        [
            ("ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
            ("mask", pa.list_(pa.bool_(), length)),
            ("ends", pa.list_(end)),
        ]
    )


class SequenceWriter:
    """One file in the Arrow IPC file format: batches of equal-length sequences.

    Columns: ``ids`` fixed-size list, ``mask`` fixed-size list (false only in the padding
    after the file's last token), ``ends`` the documents that end in the sequence with the
    position after their last id.
    """

    def __init__(self, sink, length: int, dtype, batch: int):
        self.length, self.dtype, self.rows = length, dtype, batch
        self.schema = _schema(length, dtype)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.parts, self.waiting, self.written, self.ends = [], 0, 0, []

    def add(self, doc_ids: list, ids: np.ndarray, first: np.ndarray) -> None:
        """Documents ``ids[first[i]:first[i + 1]]``, none of them empty."""
        self.ends.extend(zip(doc_ids, (first[1:] + (self.written + self.waiting)).tolist()))
        self.parts.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.length * self.rows:
            self._flush(self.waiting // self.length)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.parts) if self.parts else np.zeros(0, self.dtype)
        size = n * self.length
        taken = min(size, len(flat))
        ids = np.zeros(size, self.dtype)
        ids[:taken] = flat[:taken]
        stops = [e[1] - 1 - self.written for e in self.ends]  # place of the last id of each document
        here = int(np.searchsorted(stops, size))
        at = np.searchsorted(np.array(stops[:here], np.int64) // self.length, np.arange(n + 1))
        ends = pa.StructArray.from_arrays(
            [
                pa.array([e[0] for e in self.ends[:here]], pa.int64()),
                pa.array([s % self.length + 1 for s in stops[:here]], pa.int32()),
            ],
            fields=list(self.schema.field("ends").type.value_type),
        )
        mask = np.arange(size) < taken
        step = self.rows  # batches of one size, whatever the documents' lengths
        table = pa.record_batch(
            [
                pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), ends),
            ],
            schema=self.schema,
        )
        for i in range(0, n, step):
            self.writer.write_batch(table.slice(i, step))
        self.parts, self.waiting = [flat[taken:].copy()], len(flat) - taken
        self.written += taken
        self.ends = self.ends[here:]

    def close(self) -> int:
        if self.waiting:
            self._flush(-(-self.waiting // self.length))
        self.writer.close()
        return self.written


class SequenceFile:
    """Random access to a sequence file; on local storage ids and masks are views of the mapped file."""

    def __init__(self, uri: str):
        files, path = filesystem(uri)
        local = isinstance(files, pa.fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else files.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.sizes = None

    def batches(self):
        for i in range(self.reader.num_record_batches):
            yield self.reader.get_batch(i)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, mask)`` of sequence ``i``; the ids are not copied."""
        if self.sizes is None:
            self.sizes = np.cumsum([0] + [b.num_rows for b in self.batches()])
        k = int(np.searchsorted(self.sizes, i, side="right")) - 1
        if i < 0 or k >= len(self.sizes) - 1:
            raise IndexError(i)
        row = self.reader.get_batch(k).slice(i - int(self.sizes[k]), 1)
        ids, mask = row.column("ids").flatten(), row.column("mask").flatten()
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)


def write_sequences(
    docs: DataFrame, path: str, end_id: int, length: int = 2048, batch: int = 256, by_words: bool = True
) -> tuple[DataFrame, str]:
    """Encode ``docs`` into sequence files in ascending ``doc_id`` order (nulls first, then by text).

    Returns the table of files ``(part, file, n_docs, n_tokens)`` and the folder.  Each range of
    ids is one file, written by one task under a name of its own attempt; only files named in
    the table count, so a task that ran twice leaves nothing in the result.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/sequences-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        writer, n_docs = None, 0
        for ids_of, ids, first, dtype in encoded(batches, path, by_words, end_id):
            if writer is None:
                sink = files.open_output_stream(f"{root}/{name}")
                writer = SequenceWriter(sink, length, dtype, batch)
            writer.add(ids_of.to_pylist(), ids, first)
            n_docs += len(ids_of)
        if writer is not None:
            tokens = writer.close()
            sink.close()
            yield pa.record_batch({"part": [part], "file": [f"{folder}/{name}"], "n_docs": [n_docs], "n_tokens": [tokens]})

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    files, _ = materialize(ordered.mapInArrow(run, "part long, file string, n_docs long, n_tokens long"), "files")
    return files, folder


def read_documents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` read back from sequence files, a task for each file."""
    import zlib

    # one row for each file: as many as the partitions that wrote them
    rows = files.orderBy("part").collect()
    starts, at = [], 0
    for r in rows:
        starts.append((r.file, at))
        at += r.n_tokens
    listed = spark.createDataFrame(starts, "file string, start long")
    if starts:
        listed = listed.repartition(len(starts), "file")

    def run(batches):
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                crc, open_tokens, position = 0, 0, start
                for part in SequenceFile(uri).batches():
                    length = part.column("ids").type.list_size
                    flat = part.column("ids").flatten().to_numpy().astype("<u4")
                    view = memoryview(flat).cast("B")
                    ends = part.column("ends")
                    counts = np.diff(ends.offsets.to_numpy())
                    items = ends.flatten()
                    stops = np.repeat(np.arange(part.num_rows), counts) * length + items.field("stop").to_numpy()
                    ids, firsts, sizes, crcs, begin = items.field("doc_id"), [], [], [], 0
                    for stop in stops.tolist():
                        firsts.append(position)
                        sizes.append(open_tokens + stop - begin)
                        crcs.append(zlib.crc32(view[4 * begin : 4 * stop], crc))
                        position += sizes[-1]
                        crc, open_tokens, begin = 0, 0, stop
                    used = int(np.count_nonzero(part.column("mask").flatten().to_numpy(zero_copy_only=False)))
                    crc = zlib.crc32(view[4 * begin : 4 * used], crc)
                    open_tokens += used - begin
                    yield pa.record_batch(
                        {
                            "doc_id": ids,
                            "start": pa.array(firsts, pa.int64()),
                            "n_tokens": pa.array(sizes, pa.int64()),
                            "ids_crc32": pa.array(crcs, pa.int64()),
                        }
                    )

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
