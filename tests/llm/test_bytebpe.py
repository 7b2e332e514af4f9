"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, documents

from finwater.llm import bytebpe, queries

SF = "/root/testdata/sf0.001"
RANKS = P.path(queries.RANKS)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bytebpe.ByteBPE(bytebpe.read_ranks(RANKS), P.PATTERN, cache=500)


def digest(reference, i, text):
    ids = reference.encode_ordinary(text or "")
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    return i, len(ids), hexed(np.array(ids, dtype="<u4").tobytes()), hexed((text or "").encode())


def test_query_equals_tiktoken(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(map(tuple, queries.op7_byte_bpe(spark, SF).collect()))
    assert got == sorted(digest(reference, r["doc_id"], r["text"]) for r in docs.collect())


def test_odd_rows(spark, reference):
    got = [tuple(r) for r in queries.bpe_digests(documents(spark)).collect()]
    assert sorted(got, key=str) == sorted((digest(reference, i, t) for i, t, *_ in TEXTS), key=str)
    assert queries.bpe_digests(documents(spark).limit(0)).collect() == []


def test_offsets_and_decode(spark):
    df = documents(spark).filter("doc_id = 7")
    row = bytebpe.encode(df, RANKS, P.PATTERN, keep=["doc_id"], offsets=True).collect()[0]
    text = TEXTS[10][1]
    assert len(row["char_start"]) == row["n_tokens"] and row["char_end"][-1] == len(text)
    # several tokens share a character that is split over them
    assert any(a == b for a, b in zip(row["char_start"], row["char_start"][1:]))
    back = bytebpe.decode(bytebpe.encode(df, RANKS, P.PATTERN, keep=["doc_id"]), RANKS, P.PATTERN, keep=["doc_id"]).collect()[0]
    assert back["text"] == text and bytes(back["decoded"]) == text.encode()


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.text())
def test_any_text(reference, coder, text):
    ids = coder.encode([text])[0]
    assert ids.tolist() == reference.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()
    assert "".join(coder.stream(ids)) == text


def test_split_characters(coder):
    ids = coder.encode(["\U0001f9ff"])[0]
    assert len(ids) > 1 and coder.decode(ids[:1]).decode("utf-8", "replace") == "\ufffd"
    assert list(coder.stream(ids))[-2:] == ["\U0001f9ff", ""]
    assert "".join(coder.stream(ids[:1])) == "\ufffd"
    with pytest.raises(ValueError):
        coder.decode(np.array([60_000]))
