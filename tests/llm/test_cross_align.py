"""Alignment against whole-text encodings by both libraries and plain counts."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import accumulate

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, documents
from tokenizers import Tokenizer

from finwater.llm import cross_align, queries

SF = "/root/testdata/sf0.001"
A, B = P.path(queries.ALIGN_A), P.path(queries.ALIGN_B)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        return cross_align.Aligner(f.read(), g.read(), limit=500)


OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTES = {chr(b): b for b in OWN} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in OWN)}


def byte_level(token):
    return bytes(BYTES[c] for c in token)


def piece_bytes(piece):
    m = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(m[1], 16)]) if m else piece.replace("▁", " ").encode()


def plain(libraries, text):
    """(n_a, n_b, groups, links) of a whole text, or None."""
    a, b = libraries
    if not text:
        return None
    first, second = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    ids, ends = first.ids, []
    for tokens in (map(byte_level, first.tokens), map(piece_bytes, (b.id_to_piece(i) for i in second))):
        tokens = list(tokens)
        if b"".join(tokens) != (" " + text).encode():
            return None
        ends.append(list(accumulate(map(len, tokens))))
    common = sorted(set(ends[0]) & set(ends[1]))
    shown, links, i, j = [], [], 0, 0
    for c in common:
        x, y = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
        shown.append(",".join(map(str, ids[i:x])) + "|" + ",".join(map(str, second[j:y])))
        links.append((ids[x - 1], second[y - 1]))
        i, j = x, y
    return len(ids), len(second), ";".join(shown), links


def expected(libraries, rows):
    done = [(i, plain(libraries, t)) for i, t in rows]
    count = Counter(link for _, d in done if d for link in d[3])
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for i, d in done:
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(count[x] == top[x[1]] for x in d[3])
        sha = hashlib.sha256(d[2].encode()).hexdigest()
        out.append((i, d[0], d[1], d[2].count(";") + 1, len(d[3]), best, sum(count[x] for x in d[3]), sha))
    return sorted(out, key=str)


def test_query_equals_plain_version(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op13_cross_align(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = expected(libraries, [(r["doc_id"], r["text"]) for r in docs])
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_odd_rows(spark, libraries):
    extra = [(20, "a▁b"), (21, " "), (22, "x "), (23, "  two  spaces "), (24, "<s> </s> <|endoftext|> <0x41>"), (25, "nul \x00 tab\t")]
    schema = documents(spark).schema
    pad = lambda i, t: (i, t, "en", "s1", len(t), *("x",) * 6)
    docs = documents(spark).union(spark.createDataFrame([pad(*e) for e in extra], schema)).repartition(5)
    rows = [(i, t) for i, t, *_ in TEXTS] + extra
    want = expected(libraries, rows)
    for chunk_links in (cross_align.CHUNK_LINKS, 50):
        got = cross_align.align(docs, A, B, chunk_links=chunk_links)
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert [r for r in want if r[0] == 20] == [(20, 0, 0, 0, 0, 0, 0, "")]
    assert cross_align.align(documents(spark).limit(0), A, B).collect() == []


def test_copies_weigh_the_counts(spark, libraries):
    rows = [(i, "the very same words") for i in range(300)] + [(1000, "other words"), (1001, "the same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, cross_align.align(docs, A, B).collect()), key=str) == expected(libraries, rows)


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.one_of(st.text(), st.text(alphabet="ab .,'\n\té漢▁<>0x\U0001f600", max_size=40)))
def test_any_text(libraries, aligner, text):
    got, want = aligner.texts([text])[0], plain(libraries, text)
    assert (got is None) == (want is None)
    if want:
        assert got[:3] == want[:3]
        assert [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in got[3]] == want[3]
