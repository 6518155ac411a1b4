import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioframe.llm.packing import byte_bpe, pack, pack_documents
from folioframe.llm.sharding import shard_by_bytes
from helpers import difficult, table, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def test_shards_same_as_brute_force(spark):
    rows = difficult()
    got = {r.doc_id: r for r in shard_by_bytes(with_clashes(table(spark, rows))).collect()}
    total, done, slots = sum(len((r[1] or "").encode()) + 1 for r in rows), 0, defaultdict(int)
    for r in sorted(rows):
        raw = (r[1] or "").encode()
        shard = done * 8 // total
        g = got[r[0]]
        assert (g["size"], g.text_crc32, g.shard, g.slot) == (len(raw) + 1, zlib.crc32(raw), shard, slots[shard])
        done, slots[shard] = done + len(raw) + 1, slots[shard] + 1


def test_shards_of_repeated_and_null_ids(spark):
    rows = [(None, "a", None, None, 1), (7, "b", None, None, 1), (7, "b", None, None, 1), (7, None, None, None, 1)]
    got = shard_by_bytes(table(spark, rows), shards=2).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (0, 1), (0, 2), (1, 0)]
    assert shard_by_bytes(table(spark, [])).count() == 0


def check_packing(rows, got, capacity=1024):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append((r.start, r.length, bytes(r.ids), r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity and at & (at - 1) == 0
    for r in rows:
        ids = np.array([*LIBRARY.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for start, length, raw, n in sorted(documents[r[0]]):
            assert start == at and raw == ids[at : at + length].tobytes() and n == len(ids)
            at += length
        assert at == len(ids)


def test_packing_is_an_exact_round_trip(spark):
    rows = difficult() + [(999, "ends with <|endoftext|> inside", None, None, 1)]
    check_packing(rows, pack_documents(with_clashes(table(spark, rows)), PATH).collect())
    assert pack_documents(table(spark, []), PATH).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_same_ids_as_the_library(text):
    assert byte_bpe(PATH)(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 700), min_size=1, max_size=60))
def test_pack_fills_sequences(lengths):
    pieces = pack(np.array(lengths), 64)
    used = defaultdict(int)
    for _, _, n, s, offset in pieces:
        assert offset == used[s]
        used[s] += n
    assert sum(used.values()) == sum(lengths)
    assert all(n <= 64 and n & (n - 1) == 0 for n in used.values())
    assert sum(n < 64 for n in used.values()) <= 6
