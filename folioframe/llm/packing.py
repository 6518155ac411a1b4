"""Cost-balanced packing of token sequences.

A document costs a linear part for its tokens and a quadratic part for the attention
among them. A batch of documents is packed by itself, where it is read: nothing is shuffled. The batch's
tokens fix its sequences beforehand: as many full ones as fit, and the rest as sequences of
power-of-two lengths, which need no padding. Documents in descending order then go, each, to the sequence of
lowest cost that still has room for it; one that fits nowhere is cut over those with room. A document longer than a
sequence gives full pieces first.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from folioframe.llm.words import released

#: Documents and bytes of text packed together.
BATCH_DOCS, BATCH_BYTES = 2048, 8 << 20


def _byte_of() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 0x20 and b < 0x7F or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def byte_bpe(path: str, added_tokens: bool = True):
    """An encoder (text -> ids) for a byte-level BPE file of the tokenizers library.

    The vocabulary's ids are its merge ranks, so tiktoken gives the same ids as the
    library does, several times faster. Strings of the file's added tokens in a text are those tokens, as in
    the library; without ``added_tokens`` they are ordinary text (its ``encode_special_tokens``).
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
    byte_of = _byte_of()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    if not (added_tokens and special):
        return encoding.encode_ordinary
    if any(t.get(k) for t in model["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that depend on what is around them")
    allowed = set(special)
    return lambda text: encoding.encode(text, allowed_special=allowed, disallowed_special=())


def document_cost(tokens: np.ndarray | int, capacity: int):
    """Linear plus quadratic cost; at a full sequence both parts are equal."""
    return tokens + tokens * tokens / capacity


def plan_sequences(total: int, capacity: int) -> np.ndarray:
    """Lengths of the sequences that hold exactly so many tokens without padding."""
    full, rest = divmod(total, capacity)
    return np.array([capacity] * full + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], dtype=np.int64)


def pack(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (document, start, length, sequence, offset): where each document's tokens go."""
    room = plan_sequences(int(lengths.sum()), capacity)
    size, cost = room.copy(), np.zeros(len(room))
    out = []

    def put(doc: int, start: int, n: int, to: int) -> None:
        out.append((doc, start, n, to, int(size[to] - room[to])))
        room[to] -= n
        cost[to] += document_cost(n, capacity)

    full = 0
    for doc in np.flatnonzero(lengths >= capacity):
        for k in range(int(lengths[doc]) // capacity):
            put(int(doc), k * capacity, capacity, full)
            full += 1
    rest = lengths % capacity
    order = np.argsort(-rest, kind="stable")
    open_ = np.arange(full, len(room))
    for doc in order[: np.count_nonzero(rest)]:
        n, start = int(rest[doc]), int(lengths[doc] - rest[doc])
        fits = open_[room[open_] >= n]
        if len(fits):
            put(int(doc), start, n, int(fits[np.argmin(cost[fits])]))
        else:
            while n:
                open_ = open_[room[open_] > 0]
                to = int(open_[np.argmin(cost[open_])])
                part = min(n, int(room[to]))
                put(int(doc), start, part, to)
                n, start = n - part, start + part
        if len(out) % 64 == 0:
            open_ = open_[room[open_] > 0]
    return np.array(out, dtype=np.int64).reshape(-1, 5)


def _pack_batches(tokenizer: str, end_id: int, capacity: int, added_tokens: bool):
    def work(batches):
        encode = byte_bpe(tokenizer, added_tokens)
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
            at = 0
            while at < len(sizes):
                fit = int(np.searchsorted(np.cumsum(sizes[at : at + BATCH_DOCS]), BATCH_BYTES, side="right"))
                to = min(len(sizes), at + max(1, fit))
                tokens = [np.array([*encode(t or ""), end_id], dtype="<u4") for t in texts.slice(at, to - at).to_pylist()]
                pieces = pack(np.array([len(t) for t in tokens], dtype=np.int64), capacity)
                base = (part << 40) + number
                number += int(pieces[:, 3].max()) + 1
                doc, start, length, sequence, offset = pieces.T
                for lo in range(0, len(pieces), 4096):
                    s = slice(lo, lo + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(at, to - at).take(pa.array(doc[s])),
                            pa.array(start[s]),
                            pa.array(length[s]),
                            pa.array([tokens[d][a : a + n].tobytes() for d, a, n in zip(doc[s], start[s], length[s], strict=True)], pa.binary()),
                            pa.array([len(tokens[d]) for d in doc[s]], pa.int64()),
                            pa.array(base + sequence[s]),
                            pa.array(offset[s]),
                        ],
                        ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                    )
                at = to

    return work


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 0, added_tokens: bool = True) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens.

    Returns (``id_col``, start, length, ids, doc_tokens, sequence_id, offset), one row for each
    piece; ``ids`` are little-endian unsigned 32-bit token ids. ``end_id`` ends every document.
    Strings of the tokenizer's added tokens in a text become those tokens, unless ``added_tokens`` is false.
    Sequences are full or have a power-of-two length, so none needs padding.

    * null text is empty text: the end id alone; very long texts give many full pieces;
    * ties (documents of one length) go in input order; rows with equal ids are documents of their own;
    * null ids are kept; other columns are ignored; an empty table gives an empty table.

    ``capacity`` is a power of two. sequence_id tells the task and the sequence in it; a task that runs
    again gives the same rows.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(released(_pack_batches(tokenizer, end_id, capacity, added_tokens)), f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
