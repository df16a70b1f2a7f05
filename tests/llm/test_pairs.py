"""MinHash components, hard negatives and tokenizer alignment against brute force."""

import hashlib
import json
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cardwarden.llm import hard_negatives, minhash, token_alignment, vectors
from cardwarden.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


# --------------------------------------------------------------------------- op11
def shingle_set(text, n=5):
    words = WORD.findall(lower(text or ""))
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(rows, percent=85):
    """[(doc_id, n_shingles, component_id)] of rows (doc_id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(r[0], len(s), least[find(i)] if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def edited(seed, words, edits):
    """Copies of one text with some words replaced, so that similarities lie on both sides of the limit."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 5000, words)]
    out = []
    for k in range(edits):
        copy = list(base)
        for at in rng.choice(words, k % 6, replace=False):
            copy[at] = f"x{k}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("name", ["edge", "real"])
def test_minhash_components(request, name):
    docs = request.getfixturevalue(name)
    got = minhash.near_duplicates(docs).collect()
    assert all(g.kept == (g.doc_id == g.component_id) for g in got)
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(str, ((g.doc_id, g.n_shingles, g.component_id) for g in got))) == sorted(map(str, want))


@pytest.mark.parametrize("weight", [minhash.WEIGHT, 600])
def test_minhash_near_the_limit(docs_of, monkeypatch, weight):
    """Groups whose texts are partly below the limit to the pivot; also cut into many parts."""
    monkeypatch.setattr(minhash, "WEIGHT", weight)
    texts = [t for seed in range(3) for t in edited(seed, 60 + 40 * seed, 24)]
    got = minhash.near_duplicates(docs_of(texts)).collect()
    want = brute_components(list(enumerate(texts)))
    assert sorted((g.doc_id, g.n_shingles, g.component_id) for g in got) == sorted(want)


def test_minhash_of_nothing(empty):
    assert minhash.near_duplicates(empty).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 2**63, 2000).astype(np.uint64) for _ in range(2))
    both = [np.concatenate([a, b[:500]]), np.concatenate([a, b[500:1000]])]
    signature = minhash.signatures(np.concatenate(both), np.array([2500, 2500]), 2000)
    assert abs((signature[0] == signature[1]).mean() - 2000 / 3000) < 0.05


# --------------------------------------------------------------------------- op12
def brute_negatives(rows, scale=256, every=50):
    """``rows``: (id, label, vector)."""
    q = []
    for i, label, x in rows:
        if i is None or label is None or not x or any(c is None or not math.isfinite(c) for c in x):
            continue
        q.append((i, label, [math.floor(c * scale) for c in x]))
    out = []
    for at, (anchor, label, x) in enumerate(q):
        if anchor % every:
            continue
        others = [(sum(a * b for a, b in zip(x, y)), i, m) for k, (i, m, y) in enumerate(q) if k != at and len(y) == len(x)]
        others.sort(key=lambda o: (-o[0], o[1]))
        for score, positive, _ in [o for o in others if o[2] == label][:5]:
            inside = [o for o in others if o[2] != label and 50 * score <= 100 * o[0] <= 95 * score]
            out += [(anchor, positive, r, i, score, s) for r, (s, i, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def mined(df, **options):
    options = {"anchors": "id % 50 = 0", **options}
    columns = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    return sorted(tuple(r[c] for c in columns) for r in hard_negatives.mine(df, **options).collect())


SCHEMA = "vec_id long, embedding array<double>, label int, row string, part int, q string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, label, None, 1, "q", 0.5) for i, label, x in rows], SCHEMA)


def test_hard_negatives_of_clusters(shipped):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (4, 8))
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 4] + rng.normal(0, 0.4, 8)).tolist()) for i in range(400)]
    rows += [(i + 1000, 1, rows[0][2]) for i in range(60)]  # equal vectors: ties
    rows += [(2000, None, [1.0] * 8), (2050, 1, None), (2100, 1, [math.nan] * 8), (2150, 2, [None] + [1.0] * 7), (2200, 0, []),
             (2250, 0, [1.0, 2.0]), (2300, 0, [2.0, 1.0]), (2301, 1, [2.0, 1.0]), (None, 1, [1.0] * 8)]
    want = brute_negatives(rows)
    assert len(want) > 60
    df = frame(shipped, rows).repartition(5)
    assert mined(df) == want
    assert mined(df, group_rows=50) == want


def test_hard_negatives_of_large_components(shipped):
    rows = [(0, 1, [70000.0, 1.0]), (1, 1, [60000.0, 2.0]), (2, 2, [50000.0, 0.0]), (3, 2, [3e6, 7.0]), (50, 2, [1e7, 1.0]),
            (4, 1, [8e6, 3.0]), (5, 2, [1.0, 1.0]), (100, 1, [-1.0, 0.0]), (6, 1, [1e7, 0.5])]
    assert mined(frame(shipped, rows)) == brute_negatives(rows)
    with pytest.raises(Exception, match="range of a long"):
        mined(frame(shipped, [(0, 1, [1e9, 0.0]), (1, 1, [1e9, 1.0])]), scale=1 << 10)


def test_hard_negatives_of_repeated_ids(shipped):
    """Every row counts; one id is an anchor as often as it occurs."""
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [0.9, 0.1]), (1, 1, [1.0, 0.1]), (2, 2, [0.6, 0.5]), (2, 2, [0.6, 0.5]), (3, 2, [0.55, 0.0])]
    assert mined(frame(shipped, rows)) == brute_negatives(rows)
    assert mined(frame(shipped, rows[:2])) == []
    assert mined(frame(shipped, []).repartition(1)) == []


def test_products_stay_exact():
    big = np.array([[2**61, 3], [1, 2**31]], np.int64)
    small = np.array([[1, -1], [0, 7]], np.int64)
    assert vectors.exact_products(big, small).tolist() == [[2**61 - 3, 21], [1 - 2**31, 7 * 2**31]]


# --------------------------------------------------------------------------- op13
def brute_alignment(rows):
    a_path, b_path = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    a_lib = Tokenizer.from_file(a_path)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=b_path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    a_of = {i: bytes(byte_of[c] for c in t) for t, i in json.load(open(a_path))["model"]["vocab"].items()}

    def b_of(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for _, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        if b"".join(map(a_of.get, a)) != (full := (" " + text).encode() if text else b"") or b"".join(map(b_of, b)) != full:
            a, b = [], []
        owner = [[k for k, i in enumerate(ids) for _ in of(i)] for ids, of in ((a, a_of.get), (b, b_of))]
        links = sorted(set(zip(*owner)))
        groups, x, y, i, j = [], [], [], 0, 0
        while i < len(a) or j < len(b):
            la, lb = (sum(len(of(t)) for t in ids) for of, ids in ((a_of.get, a[:i]), (b_of, b[:j])))
            if la <= lb and i < len(a):
                x.append(a[i])
                la, i = la + len(a_of[a[i]]), i + 1
            else:
                y.append(b[j])
                lb, j = lb + len(b_of(b[j])), j + 1
            if la == lb and x and y:
                groups.append((x, y))
                x, y = [], []
        found.append((a, b, links, groups))
        counts.update((a[i], b[j]) for i, j in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (doc_id, _), (a, b, links, groups) in zip(rows, found):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n = [counts[a[i], b[j]] for i, j in links]
        is_best = sum(counts[a[i], b[j]] == best[b[j]] for i, j in links)
        sha = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), is_best, sum(n), sha))
    return out


HARD_TEXTS = ["a ▁ b", "<s> hi </s> <|endoftext|> <0x41>", "  two  spaces\t\ttabs\r\n\n", "日本語 и русский 한국어", "nul \0 byte", "ﬁ ① ½", " "]


@pytest.mark.parametrize("known", [token_alignment.KNOWN, 3])
def test_alignment(edge, docs_of, monkeypatch, known):
    """Also with nearly all counts coming from the join."""
    monkeypatch.setattr(token_alignment, "KNOWN", known)
    docs = edge.unionByName(docs_of(HARD_TEXTS, range(100, 100 + len(HARD_TEXTS)))).where("length(coalesce(text, '')) < 5000")
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    got = token_alignment.align_documents(docs, *files)
    columns = "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    want = brute_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want))


def test_alignment_of_real_texts(real):
    docs = real.where("length(text) < 1500 AND doc_id % 3 = 0")
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    want = brute_alignment([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = token_alignment.align_documents(docs, *files).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_aligned_tokens_and_nothing(docs_of, empty):
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    row = token_alignment.aligned_tokens(docs_of(["hello  world"]), *files).first()
    assert row.a_groups == sorted(row.a_groups) and row.b_groups == sorted(row.b_groups)
    assert set(row.a_groups) == set(row.b_groups) == set(range(max(row.a_groups) + 1))
    assert token_alignment.align_documents(empty, *files).count() == 0
    v = token_alignment._load(open(files[0], encoding="utf-8").read(), open(files[1], "rb").read())
    found = v.align(pa.array(["one two", ""], pa.large_string()))
    assert found.n_a.tolist()[1] == 0 and found.n_links.tolist() == (found.n_a + found.n_b - found.n_groups).tolist()


def test_encoder_gives_the_librarys_ids(real):
    raw = open(vocabulary("byte_bpe_50k.json"), encoding="utf-8").read()
    library = Tokenizer.from_str(raw)
    library.encode_special_tokens = True
    texts = [" " + (r.text or "") for r in real.select("text").collect()] + [" " + t for t in HARD_TEXTS]
    texts += ["".join(chr(c) + (" " if c % 3 else "1") for c in range(at, at + 997) if not 0xD800 <= c < 0xE000) for at in range(0, 0x110000, 9973)]
    want = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert token_alignment.encoder(raw)(texts) == want
    # Other vocabularies go to the library itself.
    spec = json.loads(raw)
    spec["normalizer"] = {"type": "Lowercase"}
    assert token_alignment.encoder(json.dumps(spec))(["Ab cD"]) == token_alignment.encoder(raw)(["ab cd"])
