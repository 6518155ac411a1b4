import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from folioframe.llm.packing import byte_bpe
from folioframe.llm.queries import op4_packing
from helpers import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
END = "<|endoftext|>"
TEXTS = [f"a {END} b", END, f"{END}{END}", f" {END}\n{END} x", f"a  {END}  b", f"<|{END}|>", "<|endoftext", f"it{END}'s 12{END}34\n\n{END}\n", f"é{END}日本 ✓"]


@pytest.mark.parametrize("text", TEXTS)
def test_added_tokens_as_in_the_library(text):
    assert byte_bpe(PATH, True)(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=8) | st.just(END)))
def test_same_ids_with_added_tokens(parts):
    assert byte_bpe(PATH, True)("".join(parts)) == LIBRARY.encode("".join(parts), add_special_tokens=False).ids


def test_query_and_stage(spark, tmp_path):
    docs = table(spark, [(i, t, None, None, 0) for i, t in enumerate(TEXTS)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    wanted = {i: np.array([*LIBRARY.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for i, t in enumerate(TEXTS)}
    for rows, crc in ((op4_packing(spark, str(tmp_path)).collect(), lambda r: r.ids_crc32), (corpus_pipeline.packing(spark, docs, "").collect(), lambda r: zlib.crc32(bytes(r.ids)))):
        assert {r.doc_id for r in rows} == set(wanted)
        for r in rows:
            assert r.doc_tokens == len(wanted[r.doc_id]) and crc(r) == zlib.crc32(wanted[r.doc_id][r.start : r.start + r.length].tobytes())
