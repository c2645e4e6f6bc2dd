"""BPE: equal to the public tokenizer library on random and given texts; appends and edits."""

import hashlib
import tracemalloc

import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from logstream.llm.bpe import (PATTERN, STAGE_PAIRS, STAGE_PIECES, Encoder, PrefixTable, _slices,
                               bpe_stage, digests, read_ranks)
from logstream.llm.queries import op4_bpe

RANKS = read_ranks(public.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("public", pat_str=public.PATTERN, mergeable_ranks=RANKS,
                            special_tokens={})
ENCODER = Encoder(RANKS)
TEXT = st.text(st.one_of(st.characters(max_codepoint=0xFF), st.characters(exclude_categories=["Cs"])),
               max_size=80)


def test_pattern_is_the_public_one():
    assert PATTERN == public.PATTERN


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_equal_to_library_and_round_trip(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode("utf-8")


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.binary(max_size=30), st.data())
def test_every_prefix_append_and_edit(data, more, draw):
    table = PrefixTable(ENCODER.vocab, data)
    for end in range(1, len(data) + 1):
        assert table.ids(end) == PrefixTable(ENCODER.vocab, data[:end]).ids()
    assert table.append(more).ids() == PrefixTable(ENCODER.vocab, data + more).ids()
    start = draw.draw(st.integers(0, len(table.data)))
    stop = draw.draw(st.integers(start, len(table.data)))
    new = draw.draw(st.binary(max_size=10))
    expect = table.data[:start] + new + table.data[stop:]
    table.replace(start, stop, new)
    assert table.data == expect and table.ids() == PrefixTable(ENCODER.vocab, expect).ids()


def test_edit_recomputes_near_the_edit_only():
    data = b"the quick brown fox jumps over the lazy dog " * 200
    table = PrefixTable(ENCODER.vocab, data)
    done = table.replace(100, 103, b"xyz")
    assert table.ids() == PrefixTable(ENCODER.vocab, data[:100] + b"xyz" + data[103:]).ids()
    assert done < 400


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, " " * 1500 + "x", "\n" * 999, "é" * 700])
def test_long_matches(text):
    assert ENCODER.encode(text) == LIBRARY.encode_ordinary(text)


def test_query_over_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op4_bpe(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = LIBRARY.encode_ordinary(d["text"])
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_nulls_empty_repeated_and_clashing_columns(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "x" * 50_000)])
    empty = hashlib.sha256(b"").hexdigest()
    rows = digests(docs, public.path("byte_bpe_50k.tiktoken")).collect()
    assert len(rows) == 6
    assert all(r["ids_sha256"] == r["decoded_sha256"] == empty for r in rows
               if r["doc_id"] in (1, 2))
    staged = bpe_stage(spark, docs, "")
    assert set(docs.columns) <= set(staged.columns)
    assert {r["doc_id"]: list(r["ids"]) for r in staged.where("doc_id = 3").collect()} == {
        3: LIBRARY.encode_ordinary("a b")}
    assert bpe_stage(spark, docs.limit(0), "").count() == 0


def test_a_task_of_the_stage_holds_little():
    enc = Encoder(RANKS)
    enc.remember(STAGE_PIECES, STAGE_PAIRS)
    tracemalloc.start()
    for i in range(0, 150_000, 100):
        text = " ".join(f"{j:x}".translate(str.maketrans("0123456789", "ghijklmnop"))
                        for j in range(i * 977, (i + 100) * 977, 977))
        assert enc.decode(enc.encode(text)) == text.encode()
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 30e6
    texts = pa.RecordBatch.from_arrays([pa.array(["x" * 100_000] * 100)], ["text"])
    parts = list(_slices(texts, 0))
    assert sum(p.num_rows for p in parts) == 100
    assert max(p.num_rows for p in parts) * 100_000 <= 2 << 20
