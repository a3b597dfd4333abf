"""Chat formatting by token-level assembly.

Each turn becomes ``opening control, text, closing control``: the texts are encoded
as segments of their own, the controls are reserved ids above the vocabulary that
no text can produce, and the loss mask is the prefix sum of +1 / -1 steps at the
borders of assistant texts.  In the written form of a conversation a control
string that occurs inside a text gets a backslash after its first character (one
more if it had some already), which is undone on the way back.

Turns are formatted row by row; a conversation is never gathered: its turns are
sorted behind each other and stream through one task, which adds up token
positions, so a conversation with a third of all rows needs no memory of its own.

Defined cases: a null text or role counts as empty; turns go by ``turn`` (nulls
first), then role, then text, repeated rows staying turns of their own; a null
``conv_id`` is one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.words import worker_store

#: control strings in the order of their reserved ids
CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]")
USER, USER_END, REPLY, REPLY_END, ROLE, ROLE_END, TURN_END = range(len(CONTROLS))
_BODY = "|".join(re.escape(c[1:]) for c in CONTROLS)
_CONTROL = re.compile(rf"([\[<])(\\*)({_BODY})")
_ESCAPED = re.compile(rf"([\[<])(\\*)\\({_BODY})")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_characters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Assembler:
    """Byte-level tokenizer with the controls as reserved ids after its vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.reserved = max(vocabulary.values()) + 1
        table = _byte_characters()
        self.bytes = [b""] * self.reserved
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()

    @classmethod
    def of_worker(cls, path: str) -> Assembler:
        store = worker_store()
        if ("chat", path) not in store:
            store["chat", path] = cls(path)
        return store["chat", path]

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for at in range(0, len(texts), 256):
            found = self.tokenizer.encode_batch(texts[at : at + 256], add_special_tokens=False)
            out.extend(x.ids for x in found)
        return out

    def turns(self, roles: list[str], texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and loss mask of every turn."""
        names = [escape(r) for r in roles if r not in ("user", "assistant")]
        segments = self.encode([escape(t) for t in texts] + names)
        other = iter(segments[len(texts) :])
        ids, masks = [], []
        for role, text in zip(roles, segments):
            if role == "user":
                parts = [[USER], text, [USER_END]]
            elif role == "assistant":
                parts = [[REPLY], text, [REPLY_END]]
            else:
                parts = [[ROLE], next(other), [ROLE_END], text, [TURN_END]]
            splice = [[self.reserved + p[0]] if k % 2 == 0 else p for k, p in enumerate(parts)]
            ids.append(np.concatenate([np.asarray(p, np.int32) for p in splice]))
            step = np.zeros(len(ids[-1]) + 1, np.int32)
            if role == "assistant":
                step[1] += 1
                step[1 + len(text)] -= 1
            masks.append(np.cumsum(step[:-1]).astype(bool))
        return ids, masks

    def text(self, ids: np.ndarray) -> str:
        """Written form of ids without controls."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode()

    def read(self, ids: np.ndarray) -> tuple[str, str, str]:
        """A turn's ids -> ``(role, text, written form)``."""
        at = np.flatnonzero(ids >= self.reserved)
        controls = (ids[at] - self.reserved).tolist()
        inner = [self.text(ids[a + 1 : b]) for a, b in zip(at, at[1:])]
        written = CONTROLS[controls[0]] + "".join(t + CONTROLS[c] for t, c in zip(inner, controls[1:]))
        role = {USER: "user", REPLY: "assistant"}.get(controls[0])
        return unescape(inner[0]) if role is None else role, unescape(inner[-1]), written


def format_conversations(turns: DataFrame, path: str) -> DataFrame:
    """``conv_id, turn, at, token_start, ids, mask`` for every turn, each conversation's turns in
    order behind each other in one partition; ``token_start`` counts its tokens before the turn."""

    def assemble(batches):
        chat = Assembler.of_worker(path)
        for batch in batches:
            ids, masks = chat.turns(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            begin = np.cumsum([0] + [len(x) for x in ids])
            flat = np.concatenate([np.zeros(0, np.int32), *ids])
            mask = np.concatenate([np.zeros(0, bool), *masks])
            offsets = pa.array(begin, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "turn", "role", "text")),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                    pa.ListArray.from_arrays(offsets, pa.array(mask)),
                ],
                names=["conv_id", "turn", "role", "text", "ids", "mask"],
            )

    def position(batches):
        conv, at, tokens = object(), 0, 0
        for batch in batches:
            sizes = np.diff(batch.column("ids").offsets.to_numpy()).tolist()
            ats, starts = [], []
            for c, n in zip(batch.column("conv_id").to_pylist(), sizes):
                if c != conv:
                    conv, at, tokens = c, 0, 0
                ats.append(at)
                starts.append(tokens)
                at, tokens = at + 1, tokens + n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array(ats, pa.int64()),
                    pa.array(starts, pa.int64()),
                    batch.column("ids"),
                    batch.column("mask"),
                ],
                names=["conv_id", "turn", "at", "token_start", "ids", "mask"],
            )

    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    made = rows.mapInArrow(
        assemble, "conv_id long, turn long, role string, text string, ids array<int>, mask array<boolean>"
    )
    ordered = made.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(
        position, "conv_id long, turn long, at long, token_start long, ids array<int>, mask array<boolean>"
    )


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """Digests of what the formatted turns hold: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_tokens``.  Reads the rows in the order they were formatted."""

    def run(batches):
        chat = Assembler.of_worker(path)
        state = None

        def out(s):
            return pa.record_batch(
                {
                    "conv_id": pa.array([s[0]], pa.int64()),
                    "n_turns": pa.array([s[1]], pa.int64()),
                    "turns_sha256": [s[2].hexdigest()],
                    "loss_chars": pa.array([s[3]], pa.int64()),
                    "loss_sha256": [s[4].hexdigest()],
                    "formatted_chars": pa.array([s[5]], pa.int64()),
                    "n_tokens": pa.array([s[6]], pa.int64()),
                }
            )

        for batch in batches:
            offsets = batch.column("ids").offsets.to_numpy()
            base = offsets[0]
            ids = batch.column("ids").flatten().to_numpy()
            mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
            done = []
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(out(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                a, b = offsets[i] - base, offsets[i + 1] - base
                role, text, written = chat.read(ids[a:b])
                loss = unescape(chat.text(ids[a:b][mask[a:b]]))
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(written)
                state[6] += int(b - a)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if state is not None:
            yield out(state)

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long",
    )
