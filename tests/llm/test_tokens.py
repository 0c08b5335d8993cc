"""Encoding against the sentencepiece library, and exact round trips of packed ids."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metagauge.llm import pfor, spm

LIB = sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)
ENCODER = spm.Encoder(spm.load(), check=True)


def encode(texts):
    ids, at, same, back = ENCODER.encode(pa.array(texts, pa.string()))
    assert same.all() and back.tolist() == ["▁" not in t for t in texts]
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs",)), max_size=60), max_size=5))
def test_any_text_encodes_as_the_library_does(texts):
    assert encode(texts) == LIB.encode(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(" \n\tab▁.é中", max_size=40), max_size=5))
def test_spaces_and_marks(texts):
    assert encode(texts) == LIB.encode(texts)


def test_documents_encode_and_decode_as_the_library_does(docs):
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    coded = spm.encode(docs)
    got = spm.decode(coded).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == LIB.encode(rows[r.doc_id]) and r.n_tokens == len(r.ids) and r.library_equal
        assert r.text == LIB.decode(r.ids) == rows[r.doc_id].replace("▁", " ") and r.decoded_equal == (r.text == rows[r.doc_id])


def test_encode_awkward(awkward):
    want = sorted(((r.doc_id, None if r.text is None else LIB.encode(r.text)) for r in awkward.select("doc_id", "text").collect()), key=repr)
    got = spm.encode(awkward).collect()
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == want
    assert all(r.library_equal and r.decoded_equal == (r.doc_id != 10) for r in got)  # 10 has a mark
    with pytest.raises(ValueError, match="ids are integers"):
        spm.encode(awkward.withColumn("doc_id", F.lit("a17")))
    assert spm.encode(awkward.limit(0)).count() == 0
    assert [r.text for r in spm.decode(spm.encode(awkward).where("ids is null")).collect()] == [None, None]


def test_unknown_ids_fail(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        spm.decode(spark.createDataFrame([([5, 10**6],)], "ids array<int>")).collect()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 40) | st.just(7), max_size=400), max_size=4), st.sampled_from([0.5, 0.9, 1.0]))
def test_packed_ids_come_back(lists, percentile):
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    ids = np.array([i for x in lists for i in x], np.int64)
    data, at, starts, blocks = pfor.pack_blocks(ids, offsets, percentile)
    done = 0
    for k, x in enumerate(lists):
        payload = data[at[k] : at[k + 1]].tobytes()
        own = starts[done : done + blocks[k]].tolist()
        done += blocks[k]
        assert pfor.unpack(payload, own).tolist() == x
        for j, s in enumerate(own):  # each block alone
            assert pfor.unpack_block(payload, s).tolist() == x[j * pfor.BLOCK : (j + 1) * pfor.BLOCK]


def test_width_is_the_percentile_and_outliers_are_exceptions():
    ids = np.array([5 + i % 4 for i in range(120)] + [10**6 + i for i in range(8)], np.int64)
    data, *_ = pfor.pack_blocks(ids, np.array([0, 128]))
    head = np.frombuffer(data.tobytes(), pfor.HEAD, 1)[0]
    assert (head["least"], head["bits"], head["last"], head["odd"]) == (5, 2, 127, 8)
    assert len(data) == 8 + 128 * 2 // 8 + 8 * 5


def test_tokenized_documents_come_back(docs):
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    packed = pfor.decode(pfor.tokenized(docs)).collect()
    assert {r.doc_id: r.ids for r in packed} == {d: LIB.encode(t) for d, t in rows.items()}
    assert sum(len(r.payload) for r in packed) < 2.2 * sum(r.n_tokens for r in packed)


def test_packed_awkward(spark, awkward):
    got = pfor.decode(pfor.tokenized(awkward)).collect()
    assert len(got) == awkward.count()
    for r in got:
        assert (r.payload is None) == (r.block_starts is None) == (r.ids is None) and r.n_tokens == len(r.ids or [])
    assert {bytes(r.payload) for r in got if r.payload is not None and r.n_tokens == 0} == {b""}
    assert pfor.tokenized(awkward.limit(0)).count() == 0
    lists = spark.createDataFrame([(7, [2**32 - 1, 0, 2**32 - 2] * 100), (1, [3, 1]), (2, []), (None, None), (4, [random.Random(1).randrange(2**31) for _ in range(1000)])], "doc_id long, ids array<long>")
    assert [r.ids for r in pfor.decode(pfor.encode_ids(lists)).collect()] == [r.ids for r in lists.collect()]


def test_shards_come_back(spark, awkward, docs, tmp_path):
    for i, table in enumerate((awkward, docs, docs.limit(0))):
        packed = pfor.tokenized(table)
        pfor.write(packed, f"file://{tmp_path}/{i}")
        as_rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
        assert as_rows(pfor.read(spark, f"file://{tmp_path}/{i}")) == as_rows(packed)
    assert len(list((tmp_path / "1").glob("*.bin"))) >= 1
