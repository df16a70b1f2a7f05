"""Byte-level BPE, prefix counts and packing against the libraries."""

import hashlib
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardwarden.llm import byte_bpe, packing, token_counts, word_bpe
from cardwarden.llm.queries import vocabulary
from cardwarden.llm.word_bpe import load

RANKS = vocabulary("byte_bpe_multi_50k.tiktoken")
WORDS = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.mark.parametrize("name", ["edge", "real"])
def test_byte_bpe_equals_tiktoken(request, tik, name):
    docs = request.getfixturevalue(name)
    got = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for r in docs.collect():
        ids = tik.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(r.text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_frequent_pieces_are_folded_once(docs_of, tik, monkeypatch):
    """Tasks that hold the same pieces fold none of them again; pieces outside the list are folded as before."""
    texts = [f"same words in every naïve task {i % 2}" for i in range(40)]
    docs, pieces = docs_of(texts).repartition(4), set(regex.findall(public_tokenizers.PATTERN, " ".join(texts)))
    pieces -= {" same"}
    for known in (1000, 2):
        monkeypatch.setattr(byte_bpe, "KNOWN", known)
        coded, frequent = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
        folded, tasks = coded.agg(F.sum(F.size("tokens")), F.count("*")).first()
        assert tasks == 4 and (folded == 0) == (known == 1000) and len(frequent.value[0]) == min(known, len(pieces))
        got = {r.doc_id: list(r.ids) for r in byte_bpe.encode_ids(docs, RANKS, public_tokenizers.PATTERN).collect()}
        assert got == {i: tik.encode_ordinary(t) for i, t in enumerate(texts)}


def test_byte_bpe_ids_and_decoding(shipped, edge, tik):
    got = byte_bpe.encode_ids(edge, RANKS, public_tokenizers.PATTERN)
    decoded = got.select("ids", byte_bpe.decode_ids(F.col("ids"), byte_bpe.read_ranks(RANKS)).alias("raw")).collect()
    assert sorted(bytes(r.raw) for r in decoded) == sorted((r.text or "").encode() for r in edge.collect())
    assert sorted(r.ids for r in decoded) == sorted(tik.encode_ordinary(r.text or "") for r in edge.collect())


def test_only_parts_that_can_be_tokens_are_looked_up(shipped, real):
    """No token is too long for the reach of its head, and most parts of a text's pieces are never looked up."""
    ranks = byte_bpe.read_ranks(RANKS)
    reach = byte_bpe.reach_literal(shipped, ranks)

    def sizes(raw):
        words = shipped.createDataFrame([(w,) for w in byte_bpe._symbols(raw).to_pylist()], "word string")
        return words.select("word", F.length("word").alias("n"))

    def at(i):
        return F.size(byte_bpe.part_sizes(F.col("word"), i, F.col("n"), reach))

    assert sizes([t for t in ranks if len(t) > 1]).where(at(F.lit(0)) < F.col("n") - 1).count() == 0
    pieces = {p for r in real.collect() for p in regex.findall(public_tokenizers.PATTERN, r.text or "")}
    rows = sizes([p.encode() for p in pieces if 1 < len(p.encode()) <= byte_bpe.BITS])
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 2)).alias("i"))
    looked_up, parts = rows.agg(F.sum(at(F.col("i"))), F.sum(F.expr("n - i - 1"))).first()
    assert looked_up < 0.6 * parts


def test_fold_of_words_of_joined_tokens(shipped, tik):
    """Tokens side by side, the longest ones too, in words around the length at which the borders leave their number."""
    ranks = byte_bpe.read_ranks(RANKS)
    rng, tokens = np.random.default_rng(5), sorted(ranks, key=len)
    raw = [b"".join(tokens[i] for i in rng.integers(len(tokens), size=k)) for k in rng.integers(1, 8, 3000)]
    raw += [(a + b)[:n] for n in (2, 3, 4, 5, 59, 60, 61, 62) for a in tokens[-20:] for b in (a[::-1] + a, a + a)]
    words = shipped.createDataFrame([(i, w) for i, w in enumerate(byte_bpe._symbols(raw).to_pylist())], "i int, word string")
    tables = byte_bpe.rank_literal(shipped, ranks), byte_bpe.reach_literal(shipped, ranks)
    for ordered in (True, False):
        got = words.select("i", F.get(byte_bpe.fold_merges(F.array("word"), *tables, ordered), F.lit(0)).alias("ids")).collect()
        assert {r.i: list(r.ids) for r in got} == {i: tik._encode_single_piece(w) for i, w in enumerate(raw)}


def test_long_pieces_and_new_numbering(docs_of, tik, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 3)
    monkeypatch.setattr(byte_bpe, "SLICE", 40)
    docs = docs_of(["ab" * 400, "one two three", "two four one five", "ab" * 400, "six"] * 3).coalesce(1)
    got = byte_bpe.encode_ids(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: r.ids for r in got} == {r.doc_id: tik.encode_ordinary(r.text) for r in docs.collect()}


@pytest.mark.parametrize("name", ["edge", "real"])
def test_prefix_counts_equal_library(request, library, name):
    docs = request.getfixturevalue(name)
    counts = token_counts.prefix_token_counts(docs, WORDS)
    got = counts.select("doc_id", "n_bytes", token_counts.total_tokens(F.col("prefix_tokens"))).collect()
    want = [
        (r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in docs.collect()
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_every_prefix_and_its_questions(docs_of, library):
    texts = ["The quick, brown foxes don't <|endoftext|> jump\n over 1234 naïve ΑΣ dogs.", "", None, "unbelievably long-winded"]
    counts = token_counts.prefix_token_counts(docs_of(texts), WORDS)
    c = F.col("prefix_tokens")
    rows = counts.select(
        "doc_id", c, token_counts.tokens_of_first(c, 9).alias("nine"), token_counts.characters_within(c, 3).alias("three")
    ).collect()
    for r in rows:
        text = texts[r.doc_id] or ""
        want = [len(library.encode(text[: i + 1], add_special_tokens=False).ids) for i in range(len(text))]
        assert r.prefix_tokens == want
        assert r.nine == ([0, *want][min(9, len(text))])
        assert r.three == max([0, *(i + 1 for i, n in enumerate(want) if n <= 3)])


def test_very_long_words_equal_library(library, monkeypatch):
    own, rng = load(open(WORDS, encoding="utf-8").read()), np.random.default_rng(5)
    million = "".join(map(chr, rng.integers(97, 123, 1_000_000)))
    begun = time.monotonic()
    flat, _ = own.encode([million])
    counts, _ = own.prefix_counts([million])
    assert time.monotonic() - begun < 60
    assert flat.tolist() == library.encode(million, add_special_tokens=False).ids
    assert counts[-1] == len(flat) and counts[999] == len(library.encode(million[:1000], add_special_tokens=False).ids)
    monkeypatch.setattr(word_bpe, "LONG_BLOCK", 100)
    for word in [million[:777], "x" * 500, "la" * 300, "thequickbrownfox" * 40, "ßé" * 90, "!?" * 120]:
        assert own.encode([word])[0].tolist() == library.encode(word, add_special_tokens=False).ids
        want = [len(library.encode(word[: i + 1], add_special_tokens=False).ids) for i in range(len(word))]
        assert own.prefix_counts([word])[0].tolist() == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters=" \t\n\r\x0b\x0c"), max_size=12), max_size=5))
def test_words_equal_library(words):
    own = load(open(WORDS, encoding="utf-8").read())
    flat, sizes = own.encode(words)
    ids = [own.library().encode(w, add_special_tokens=False).ids for w in words]
    assert flat.tolist() == [i for x in ids for i in x] and sizes.tolist() == [len(x) for x in ids]
    counts, lengths = own.prefix_counts(words)
    assert counts.tolist() == [
        len(own.library().encode(w[: i + 1], add_special_tokens=False).ids) for w in words for i in range(len(w))
    ]
    assert lengths.tolist() == [len(w) for w in words]


def check_packing(rows, texts_by_id, library, capacity):
    """``texts_by_id``: texts of unique ids."""
    places, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.array(library.encode(texts_by_id[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        places[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, parts in [*places.items(), *sequences.items()]:
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist(), key
    assert all(sum(n for _, n in parts) <= capacity for parts in sequences.values())
    assert set(places) == set(texts_by_id)
    return sum(r.length for r in rows) / (capacity * len(sequences))


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(real, docs_of, library, capacity):
    texts = {r.doc_id: r.text for r in real.collect()} | {-1: None, -2: ""}
    docs = real.select("doc_id", "text").unionByName(docs_of([None, ""], [-1, -2]).select("doc_id", "text"))
    used = check_packing(packing.pack(docs, WORDS, capacity).collect(), texts, library, capacity)
    assert used > 0.95


def test_packing_edge_rows(edge, empty):
    rows = packing.pack(edge, WORDS, 64, with_ids=True).collect()
    assert sum(r.start == 0 for r in rows) == edge.count()
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(empty, WORDS, 64).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 500), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    held = defaultdict(int)
    for pattern, packs in packing.shortest_pack_first(histogram, 32):
        assert packs > 0 and sum(n * c for n, c in pattern) <= 32
        for length, copies in pattern:
            held[length] += copies * packs
    assert held == histogram


def test_equal_lengths_share_packs():
    assert packing.shortest_pack_first({500: 1000}, 2048) == [([(500, 4)], 250)]


def test_empty_tables(empty):
    assert byte_bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.prefix_token_counts(empty, WORDS).count() == 0
