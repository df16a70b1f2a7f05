"""Exact, near and substring duplicates against brute force."""

import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from cardwarden.llm import exact_dedup, simhash, substring_dedup
from cardwarden.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


# --------------------------------------------------------------------------- exact
@pytest.mark.parametrize("name", ["edge", "real"])
@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (2, 3)])
def test_exact_groups(request, name, primes):
    """Also with fingerprints so short that different texts share them."""
    docs = request.getfixturevalue(name)
    rows = docs.collect()
    norm = [SPACE.sub(" ", r.text or "") for r in rows]
    sizes, least = Counter(norm), {}
    for r, t in zip(rows, norm):
        least[t] = min([x for x in (least.get(t), r.doc_id) if x is not None], default=None)
    got = exact_dedup.exact_groups(docs, primes=primes).collect()
    want = [(r.doc_id, least[t], sizes[t], sha(t)) for r, t in zip(rows, norm)]
    assert sorted(map(str, ((g.doc_id, g.keep_id, g.group_size, g.text_sha256) for g in got))) == sorted(map(str, want))
    assert sorted(g.text_sha256 for g in got if g.kept) == sorted(map(sha, sizes))
    assert all(g.doc_id == g.keep_id for g in got if g.kept)


def test_exact_keeps_all_columns(edge, empty):
    kept = exact_dedup.drop_exact_copies(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len({SPACE.sub(" ", r.text or "") for r in edge.collect()})
    assert exact_dedup.drop_exact_copies(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=20_000), st.integers(0, 20_000))
def test_fingerprints_compose(data, cut):
    cut = min(cut, len(data))
    for prime, base in zip(exact_dedup.PRIMES, exact_dedup.BASES):

        def whole(part):
            h = 0
            for b in part:
                h = (h * base + b + 1) % prime
            return h

        parts = [np.array([whole(x)], np.uint64) for x in (data[:cut], data[cut:])]
        joined = exact_dedup.combine(*parts, np.array([len(data) - cut]), prime, base)
        assert int(joined[0]) == whole(data)
    flat = np.frombuffer(data, np.uint8)
    got = exact_dedup.fingerprints(flat, np.array([0, len(data)]))[0]
    a, b = (
        int(exact_dedup.fingerprints(flat, np.array([0, len(data)]), (p,), (q,))[0])
        for p, q in zip(exact_dedup.PRIMES, exact_dedup.BASES)
    )
    assert got == (a << 31 | b)


# --------------------------------------------------------------------------- near
def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("name", ["edge", "real"])
def test_near_components(request, name):
    docs = request.getfixturevalue(name)
    rows = docs.collect()
    fps = np.array([plain_fingerprint(r.text) for r in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    ids = np.array([2**62 if r.doc_id is None else r.doc_id for r in rows])
    while True:
        new = np.where(near, ids[None, :], 2**62).min(1)
        if (new == ids).all():
            break
        ids = new
    got = simhash.near_duplicate_components(docs).collect()
    want = [(r.doc_id, f"{f:016x}", None if c == 2**62 else int(c)) for r, f, c in zip(rows, fps, ids)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_near_stage_equals_brute_force(shipped, docs_of, edge, empty):
    """Edited copies at many distances and chains of them: the stage keeps the smallest id of each component."""
    rng = np.random.default_rng(3)
    texts = []
    for size in (4, 5, 9, 120, 400, 2000):
        for _ in range(4):
            words = [f"w{x}" for x in rng.integers(0, 5000, size)]
            for _ in range(6):
                texts.append(" ".join(words))
                for at in rng.integers(0, size, rng.integers(0, 3)):
                    words[at] = f"w{rng.integers(0, 5000)}"
    ids = rng.permutation(len(texts)).tolist()
    docs = docs_of(texts, ids).repartition(5)
    fps = {i: plain_fingerprint(t) for i, t in zip(ids, texts)}
    label = {i: i for i in ids}
    near = [(i, j) for i in ids for j in ids if i < j and (int(fps[i]) ^ int(fps[j])).bit_count() <= 2]
    for _ in ids:
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    got = corpus_pipeline.near_stage(shipped, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(label.values()))
    assert len({f for f in fps.values()}) > len(set(label.values())) < len(texts)
    assert corpus_pipeline.near_stage(shipped, empty, "").count() == 0
    # Rows without an id are not mistaken for each other.
    assert max(Counter(int(plain_fingerprint(r.text)) for r in corpus_pipeline.near_stage(shipped, edge, "").collect()).values()) == 1


def test_near_keeps_one_of_each_component(edge, empty):
    fps = np.array([plain_fingerprint(r.text) for r in edge.collect()], np.uint64)
    label, near = fps, np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    for _ in fps:
        label = np.where(near, label[None, :], np.uint64(2**64 - 1)).min(1)
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len(set(label.tolist()))
    assert simhash.keep_first(empty).count() == 0


@pytest.mark.parametrize("part_rows", [3, 50, None])
@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_tiles_find_all_links(shipped, part_rows, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 64, 40, np.uint64)
    flips = [np.bitwise_xor.reduce([np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, n)]) for n in rng.integers(1, 5, 300)]
    fps = np.unique(np.concatenate([base, rng.choice(base, 300) ^ np.array(flips, np.uint64), np.array([0, 1, 3, 2**64 - 1], np.uint64)]))
    table = shipped.createDataFrame([(int(x),) for x in fps.astype(np.int64)], "fp long")
    links = simhash.links_within(table, radius, part_rows)
    roots = {r.node: r.root for r in components(links).collect()}
    got = [roots.get(int(x), int(x)) for x in fps.astype(np.int64)]
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = fps.astype(np.int64)
    while True:
        new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
        if (new == label).all():
            break
        label = new
    assert got == label.tolist()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=12), max_size=6))
def test_majority(runs):
    flat = np.array([h for r in runs for h in r], np.uint64)
    got = simhash.majority(flat, np.array([len(r) for r in runs], np.int64))
    assert [int(x) for x in got] == [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r) > len(r)) for r in runs]


def test_components(shipped):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (100, 101), (200, 200)]
    links = shipped.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}
    assert components(links.where("a < 0")).count() == 0


# --------------------------------------------------------------------------- substrings
def check_removed(docs, window, k):
    rows = docs.collect()
    words = [WORD.findall(r.text or "") for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    want = []
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        want.append((r.doc_id, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    got = substring_dedup.remove_repeated(docs, window, k=k).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(r.n_removed for r in got)


@pytest.mark.parametrize("name", ["edge", "real"])
def test_repeated_windows(request, name):
    check_removed(request.getfixturevalue(name), 35, 16)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_windows_of_few_words(docs_of, seed):
    """A small alphabet repeats windows within and across texts in all ways."""
    rng = np.random.default_rng(seed)
    texts = [" ".join(rng.choice(list("abcd"[: 2 + seed % 3]), rng.integers(0, 60))) for _ in range(30)]
    check_removed(docs_of(texts + texts[:2]).repartition(3), 6, 2 + seed)


def test_texts_without_their_repeated_words(edge, empty):
    out = substring_dedup.without_repeated(edge, 35)
    assert out.columns == edge.columns and out.count() == edge.count()
    texts = {r.text for r in out.collect()}
    assert "start end" in texts and "other tail of it" in texts and "the  quick\nbrown fox" in texts
    assert substring_dedup.without_repeated(empty, 35).count() == 0


def test_rolling_hashes_do_not_depend_on_place():
    words = np.arange(1, 50, dtype=np.uint64)
    twice = np.concatenate([words, words])
    rolling = substring_dedup.Rolling(twice, 0x9E3779B97F4A7C15, 35)
    at = np.arange(10)
    assert (rolling.of(at, at + 35) == rolling.of(at + 49, at + 49 + 35)).all()
    assert isinstance(pa.array(rolling.of(at, at + 35)), pa.Array)


def test_scans_hold_little_beside_a_batch(shipped):
    """Arrays of word positions are many times as large as the text they stand for."""
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 9000, 400))) for _ in range(4000)]
    batch = pa.RecordBatch.from_pydict({"id": [0] * len(texts), "text": texts})

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    def emit(words, _):
        found = substring_dedup.anchors(words, 35)
        return [found.hashes.astype(np.int64)]

    run = substring_dedup._scan(Docs(), emit, "a bigint", "text")
    tracemalloc.start()
    assert sum(b.num_rows for b in run(iter([batch]))) > 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
