"""Huffman-coded id files: optimal lengths, round trips, and the query against
the tokenizers library text by text."""

import heapq
import itertools
import json
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, documents
from tokenizers import Tokenizer

from finwater.llm import cuts, huffman, queries

SF = "/root/testdata/sf0.001"
FILE = P.path(queries.ID_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def tokens():
    with open(FILE, encoding="utf-8") as f:
        return huffman.Tokens(f.read())


def expected(library, rows):
    """The rows of the query from (doc_id, text) pairs in order."""
    out, start = [], 0
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def huffman_cost(counts):
    """Total bits of an unlimited Huffman code."""
    heap, total = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def best_limited(counts, limit):
    """Least total bits over all length assignments that satisfy Kraft."""
    return min(
        sum(c * b for c, b in zip(counts, bits))
        for bits in itertools.product(range(1, limit + 1), repeat=len(counts))
        if sum(2.0**-b for b in bits) <= 1
    )


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=40))
def test_lengths_are_optimal_and_a_prefix_code(counts):
    counts = np.array(counts)
    bits = huffman.code_lengths(counts, 40)
    assert ((bits > 0) == (counts > 0)).all()
    if (counts > 0).sum() > 1:
        assert int((counts * bits).sum()) == huffman_cost(counts.tolist())
        assert sum(2.0 ** -b for b in bits[bits > 0].tolist()) == 1
    codes = huffman.canonical(bits)
    shown = [format(c, f"0{b}b") for c, b in zip(codes.tolist(), bits.tolist()) if b]
    assert not any(a != b and b.startswith(a) for a in shown for b in shown) and len(set(shown)) == len(shown)


def test_limited_lengths_are_optimal():
    for counts in ([1, 1, 2, 3, 5, 8], [100, 50, 20, 5, 1], [1, 1, 1, 1, 1000]):
        bits = huffman.code_lengths(np.array(counts), 3)
        assert bits.max() <= 3 and int((np.array(counts) * bits).sum()) == best_limited(counts, 3)
    # more ids than 2^limit codes: the limit rises to what they need
    assert huffman.code_lengths(np.ones(9, dtype=np.int64), 3).max() == 4


@settings(max_examples=40, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 50), max_size=700), st.integers(1, 300))
def test_round_trip_from_every_checkpoint(ids, step):
    ids = np.array(ids, dtype=np.int64)
    counts = np.bincount(ids, minlength=51)
    coder = huffman.Coder(np.arange(51), huffman.code_lengths(counts))
    payload, at = coder.encode(ids)
    points = at[::step]
    assert (coder.decode(payload, points, huffman._runs(points, len(ids), step)) == ids).all()


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.one_of(st.text(), st.text(alphabet="ab'st,.-12 \n\té²_\x1c\x85 ", max_size=40)))
def test_parts_give_the_library_s_ids(library, tokens, text):
    assert "".join(cuts.spaced(text)) == text
    assert tokens.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_memory_starts_anew(library):
    with open(FILE, encoding="utf-8") as f:
        tokens = huffman.Tokens(f.read(), limit=3)
    for text in ["a b c d e f", "c d <|endoftext|> x", "a" * 200, "a b c d e f"]:
        assert tokens.encode([text, text])[1].tolist() == library.encode(text, add_special_tokens=False).ids


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, model):
        self.__dict__.update(model=model, given=0)

    def __setattr__(self, name, value):
        setattr(self.model, name, value)

    def encode_batch_fast(self, texts, **options):
        self.__dict__["given"] += len(texts)
        return self.model.encode_batch_fast(texts, **options)


def test_single_matches_go_to_the_library_together(library):
    with open(FILE, encoding="utf-8") as f:
        tokens = huffman.Tokens(f.read())
    words = [a + b + c for a in "aéЖ中한" for b in map(chr, range(ord("a"), ord("z") + 1)) for c in ("", "xq", "tion", "ß")]
    text = " ".join([*words, *map(str, range(300)), "<|endoftext|>", "x's", "a\n\nb", "...", "'", "1.5", "½", "\ufffd"])
    tokens.model = Counted(tokens.model)
    assert tokens.encode([text, "é"])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert tokens.model.given < 20  # one by one: more than 800


def test_characters_of_single_matches(library):
    """The library's pattern takes all characters that count as certain as one match."""
    kinds = re.findall(r"\[(.+?)\]\+", huffman._LONE)
    assert len(kinds) == 3
    for kind in kinds:
        found = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), kind) + "]")
        text = "".join(filter(found.match, map(chr, range(0xD800))))
        for t in (text, " " + text, text[::-1]):
            assert len(library.pre_tokenizer.pre_tokenize_str(t)) == 1


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="aZqéßøȺЖя҂中한07.,'<|^_ \n\0×", max_size=12), max_size=6))
def test_mixed_parts_give_the_library_s_ids(library, tokens, texts):
    assert [i.tolist() for i in tokens.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_only_plain_byte_level_files_skip_the_cutting():
    with open(FILE, encoding="utf-8") as f:
        config = json.load(f)
    assert huffman._byte_sizes(config)[config["model"]["vocab"]["Ġthe"]] == 4
    token = {**config["added_tokens"][0], "special": False}
    for other in (
        {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"pre_tokenizer": {**config["pre_tokenizer"], "add_prefix_space": True}},
        {"added_tokens": [token]}, {"model": {**config["model"], "dropout": 0.1}}, {"model": {"type": "Unigram", "vocab": []}},
    ):
        assert huffman._byte_sizes({**config, **other}) is None


def test_memory_is_not_hashed_anew_for_each_group(monkeypatch):
    told, sets, look = [], [], cuts.pc.index_in
    monkeypatch.setattr(cuts.pc, "index_in", lambda values, value_set: sets.append(len(value_set)) or look(values, value_set=value_set))
    memory = cuts.Memory(told.extend, told.clear)
    for first in (0, 3, 40, 20):
        parts = [f"p{i}" for i in range(first, first + 30)][::-1]
        assert [told[n] for n in memory.numbers(pa.array(parts))] == parts
    assert len(told) == 70 and max(sets) <= 30


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op11_id_files(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(library, [(r["doc_id"], r["text"]) for r in docs])


def test_odd_rows_spans_and_empty_table(spark, library, scratch):
    docs = documents(spark).repartition(3)
    path = huffman.write(docs, scratch + "/odd", FILE, end_id=2, block_ids=500, step=64)
    got = sorted(map(tuple, huffman.read(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((t[0] for t in TEXTS), key=lambda i: (i is not None, i))
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and got[0][1] == 0
    ids = lambda text: np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
    assert sorted(((r[0], bytes(r[3])) for r in got), key=str) == sorted(((i, ids(t)) for i, t, *_ in TEXTS), key=str)
    stream = b"".join(bytes(r[3]) for r in got)
    for first, count in ((0, 10), (63, 2), (700, 5000), (len(stream) // 4 - 3, 3)):
        rows = sorted(map(tuple, huffman.read_span(spark, path, first, count).collect()))
        assert rows[0][0] == first and b"".join(bytes(r[1]) for r in rows) == stream[4 * first : 4 * (first + count)]
    blocks = spark.read.parquet(path + "/blocks")
    assert blocks.count() >= 3 and blocks.selectExpr("sum(length(payload))").first()[0] < len(stream) / 2
    empty = huffman.write(documents(spark).limit(0), scratch + "/none", FILE, end_id=2)
    assert huffman.read(spark, empty).collect() == []


def test_one_id_only(spark, scratch):
    docs = spark.createDataFrame([(i, None) for i in range(5)], "doc_id long, text string")
    path = huffman.write(docs, scratch + "/one", FILE, end_id=2)
    assert sorted((r["doc_id"], r["start"], bytes(r["ids"])) for r in huffman.read(spark, path).collect()) == [
        (i, i, b"\2\0\0\0") for i in range(5)
    ]
