"""WARC archives, toxicity, language model, search and the pipeline against brute force."""

import base64
import gzip
import hashlib
import io
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from cardwarden.llm import lm_scoring, topk, toxicity, warc
from cardwarden.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --------------------------------------------------------------------------- WARC
PAGES = [
    (5, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""),
    (4, "é", "Größe \x1f\u008b\x08"), (None, "u", "same"), (7, "u", "x" * 300_000), (8, "u", "solo"), (None, "u", "lonely"),
]


@pytest.mark.parametrize("least_bytes, range_bytes", [(0, 64), (0, 1 << 22), (5, 300)])
def test_archives_round_trip(shipped, least_bytes, range_bytes):
    pages = shipped.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    got = warc.round_trip(pages, least_bytes, range_bytes).collect()
    firsts = {}
    for page, _, html in PAGES:
        if page is not None and len((html or "").encode()) >= least_bytes:
            firsts[html or ""] = min(firsts.get(html or "", page), page)
    counts = Counter(h or "" for _, _, h in PAGES)
    want = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        first = firsts.get(html or "") if counts[html or ""] > 1 else None
        refers = None if page == first else first
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((page, len(raw), digest, "response" if refers is None else "revisit", refers))
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_archives_are_plain_gzip_and_listed(shipped):
    pages = shipped.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    folder = scratch_path(shipped, "warc")
    path = warc.write_archives(pages, folder).first()["path"]
    raw = open(path.removeprefix("file:"), "rb").read()
    assert gzip.GzipFile(fileobj=io.BytesIO(raw)).read().count(b"WARC/1.1\r\n") == len(PAGES)
    listed = warc.list_archives(shipped, folder)
    assert warc.read_archives(listed, payloads=True, range_bytes=100).where("payload is not null").count() == 6
    empty = pages.where("page_id = -1")
    assert warc.round_trip(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=60), max_size=8), st.integers(1, 200), st.integers(0, 9))
def test_every_member_is_owned_once(payloads, step, level):
    records = [warc.record(i, "u", p + warc.MAGIC, "d", None) for i, p in enumerate(payloads)]
    data = b"".join(warc.member(r, level) for r in records)
    got = [m for at in range(0, len(data), step) for m in warc.members(io.BytesIO(data), at, at + step, len(data))]
    assert got == records


@pytest.mark.parametrize("range_bytes", [61, 100, 300, 500, 1 << 22])
def test_members_inside_members_are_no_records(shipped, tmp_path, range_bytes):
    inner = b"".join(warc.member(warc.record(i, "in", b"inner %d" % i, "d", None)) for i in range(90, 93))
    nested = warc.member(warc.record(80, "mid", b"<" + inner + b">", "d", None), level=0)
    payloads = [b"first", b"[" + inner + b"]" * 200, b"last", b"#" + nested + b"#", b""]
    path = tmp_path / "others.warc.gz"
    path.write_bytes(b"".join(warc.member(warc.record(i, "u", p, "d", None), 0) for i, p in enumerate(payloads)))
    listed = warc.list_archives(shipped, str(tmp_path))
    rows = warc.read_archives(listed, payloads=True, range_bytes=range_bytes).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in rows) == list(enumerate(payloads))


def test_a_very_large_record_is_read_in_linear_time():
    payload = np.random.default_rng(1).bytes(64 << 20) * 3
    data = warc.member(warc.record(1, "u", payload, "d", None), level=0) + warc.member(warc.record(2, "u", b"x", "d", None))
    begun = time.monotonic()
    found = list(warc.located_members(io.BytesIO(data), 0, 4 << 20, len(data), warc.Record))
    assert time.monotonic() - begun < 15
    assert [(row["page_id"], row["payload_bytes"], row["payload_digest"]) for _, _, row in found] == [
        (1, len(payload), warc.payload_digest(payload))
    ]


def test_ids_that_are_no_numbers(shipped):
    pages = shipped.createDataFrame([("7", "u", "a"), ("x", "u", "a"), (None, "u", "b")], "page_id string, url string, html string")
    rows = warc.round_trip(pages).collect()
    assert sorted((str(r.page_id), r.record_type) for r in rows) == [("7", "response"), ("None", "response"), ("None", "revisit")]


# --------------------------------------------------------------------------- toxicity
def test_grammar_reads_clauses():
    labels = {}
    for sentence in ([1], [3, 1], [1, 3], [4, 1], [5, 1, 3], [2, 3], [2], [4, 2, 3], [3], [0, 4]):
        state, weight = 0, 0.0
        for symbol in sentence:
            state, factor = toxicity.GRAMMAR.arcs[state][symbol]
            weight += factor
        labels[tuple(sentence)] = (toxicity._kind(toxicity.GRAMMAR.finals[state]), weight)
    assert labels == {
        (1,): (2, 1.0), (3, 1): (1, 1.0), (1, 3): (1, 1.0), (4, 1): (3, 1.0), (5, 1, 3): (4, 1.0), (2, 3): (5, 1.0),
        (2,): (6, 1.0), (4, 2, 3): (6, 1.0), (3,): (0, 0.0), (0, 4): (0, 0.0),
    }


def test_held_out_accuracy(shipped):
    folder = "/root/testdata/sf0.1"
    docs, labels = (shipped.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in held if r.toxic == 1]
    clean = [r.predicted for r in held if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.02


def test_toxicity_edge_rows(edge, empty, shipped):
    labels = shipped.createDataFrame([(0, None), (1, 1), (1, 0), (2, 0), (None, 1)], "doc_id long, toxic int")
    for some in (labels, labels.where("false")):
        rows = toxicity.score(edge, toxicity.fit(edge, some)).collect()
        assert len(rows) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert toxicity.drop_toxic(edge, some).columns == edge.columns
    assert toxicity.drop_toxic(empty, labels).count() == 0


# --------------------------------------------------------------------------- language model
def check_scores(docs):
    rows = docs.collect()
    texts = [re.sub("[A-Z]+", lambda m: m[0].lower(), r.text or "") for r in rows]
    tokens = [[*WORD.findall(t), "\n"] for t in texts]
    held = [zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 1 for r in rows]
    counts = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws) for ws in tokens]
    want = [(r.doc_id, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(b, 6)) for r, h, ws, b in zip(rows, held, tokens, base)]
    got = lm_scoring.score(docs, fit_tokens=100_000).collect()
    assert sorted(str((g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6))) for g in got) == sorted(map(str, want))
    return got


def test_scores_of_edge_rows(edge, empty):
    assert all(math.isfinite(g.score) and g.score <= 0 for g in check_scores(edge))
    assert lm_scoring.score(empty).count() == 0


def test_model_beats_the_base_on_held_out_texts(real, monkeypatch):
    monkeypatch.setattr(lm_scoring, "KNOWN", 500)
    held = [g for g in check_scores(real) if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_model_learns_from_all_training_texts(docs_of):
    """One text above ``fit_tokens`` tokens, and many that exceed it together."""
    def gain(docs):
        rows = lm_scoring.score(docs, fit_tokens=1000).collect()
        return sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)

    assert gain(docs_of(["ab cd ef gh " * 5000])) > 0.3
    # Several tasks and rounds; copies of one text share a round.
    texts = ["one two three four five six seven " * 30] * 60 + [f"ab cd ef gh {i} " * 40 for i in range(100)]
    assert gain(docs_of(texts).repartition(5)) > 0


def test_training_follows_one_schedule_at_any_size(docs_of):
    """Corpora below, around and above ``fit_tokens`` tokens are learned in the same rounds."""
    docs = docs_of([f"ab cd ef gh {i} " * 20 for i in range(40)]).coalesce(1)
    some, *others = (
        sorted((r.doc_id, r.score) for r in lm_scoring.score(docs, fit_tokens=n).collect()) for n in (10**6, 4000, 1500)
    )
    assert all(other == some for other in others)


def test_probabilities_are_normalised():
    rng = np.random.default_rng(1)
    sequence, bounds = rng.integers(0, lm_scoring.CLASSES, 300), np.array([0, 100, 100, 300])
    model = lm_scoring.train(sequence, bounds, np.bincount(sequence, minlength=lm_scoring.CLASSES), rounds=1)
    context = lm_scoring.contexts(sequence, bounds)[:, [0, 57, 299]]
    for at in range(3):
        every = np.arange(lm_scoring.CLASSES)
        p = model.log10(np.repeat(context[:, at : at + 1], len(every), 1), every, block=100)
        assert (10**p).sum() == pytest.approx(1.0, abs=1e-5)


def test_normalisers_need_no_exponential_a_context(monkeypatch):
    """One exponential for each class, place and class before; large logits, taken one by one, give the same."""
    rng = np.random.default_rng(2)
    sequence, bounds = rng.integers(0, lm_scoring.CLASSES, 5000), np.array([0, 1000, 1000, 5000])
    model = lm_scoring.train(sequence, bounds, np.bincount(sequence, minlength=lm_scoring.CLASSES), rounds=1)
    context = lm_scoring.contexts(sequence, bounds)
    tables = np.einsum("cw,pwv->pcv", model.inputs, model.places)
    logits = sum(t[c] for t, c in zip(tables, context)) @ model.outputs.T + model.bias
    want = (logits[np.arange(5000), sequence] - np.log(np.exp(logits).sum(1))) / np.log(10)
    exponentials, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **b: exponentials.append(np.size(x)) or exp(x, *a, **b))
    assert np.abs(model.log10(context, sequence) - want).max() < 1e-5
    assert sum(exponentials) < 4 * lm_scoring.CLASSES * (lm_scoring.CLASSES + 1)
    model.outputs[0, :] = 500.0
    logits = sum(t[c] for t, c in zip(tables, context)) @ model.outputs.T + model.bias
    top = logits.max(1, keepdims=True)
    want = (logits - top - np.log(exp(logits - top).sum(1, keepdims=True)))[np.arange(5000), sequence] / np.log(10)
    assert np.abs(model.log10(context, sequence) - want).max() < 1e-3


# --------------------------------------------------------------------------- search
@pytest.mark.parametrize("group_rows", [20, 1000])
def test_search_equals_brute_force(shipped, group_rows):
    """Ties, repeated ids, large components, rows that take no part, lists of another length."""
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(300, 8)) * rng.exponential(1, (300, 1)), 2)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(300, rows[7][1]), (301, rows[7][1]), (302, None), (303, [1.0, None]), (304, [float("nan")] * 8), (305, []),
             (306, [float("inf")] * 8), (None, rows[3][1]), (400, [1.0, 2.0]), (401, [2.0, 1.0]), (200, rows[9][1]), (8, rows[9][1]),
             (500, [70000.0, 1.0, 0.0]), (501, [1.0, 70000.0, 0.0]), (502, [0.0, 1.0, 2.0**70]), (500, [0.0] * 3)]
    table = shipped.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = topk.top_k(table, "id % 100 = 0", 10, fit_rows=50, group_rows=group_rows).collect()
    gone = (303, 304, 306)
    valid = [(i, [int(np.floor(1024 * c)) for c in v]) for i, v in rows if i is not None and v and i not in gone]
    want = []
    for at, (q, v) in enumerate(valid):
        if q % 100 == 0:
            others = [(i, w) for j, (i, w) in enumerate(valid) if j != at and len(w) == len(v)]
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in others)[:10]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert (500, 1, 501, 2 * 71680000 * 1024) in want
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(table.where("false"), "id % 100 = 0").count() == 0


def test_search_refuses_scores_beyond_a_long(shipped):
    table = shipped.createDataFrame([(0, [2.0**60]), (1, [2.0**60])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="range of a long"):
        topk.top_k(table, "id % 100 = 0").collect()


def test_queries_go_only_to_groups_that_can_reach_their_floor(shipped):
    """Vectors of falling length along one line: the ten longest are the answer, and only their group is asked."""
    rows = [(i, [float(1000 - i), 0.0]) for i in range(1000)]
    table = shipped.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = topk.top_k(table, "id = 500", 10, fit_rows=32, group_rows=50)
    assert [(r.rank, r.vec_id) for r in out.orderBy("rank").collect()] == [(n + 1, n) for n in range(10)]


def test_products_stay_exact():
    big = np.array([[1 << 26, (1 << 26) - 1]] * 2, np.int32)
    assert topk.exact_products(big, big)[0, 0] == (1 << 52) + ((1 << 26) - 1) ** 2
    assert topk.row_products(big, big).tolist() == [(1 << 52) + ((1 << 26) - 1) ** 2] * 2


# --------------------------------------------------------------------------- the pipeline
def test_pipeline_stages_agree_with_their_operators(shipped, sf_dir):
    docs = shipped.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.run(shipped, sf_dir).collect()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
    labels = {r.doc_id: r.toxic for r in shipped.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in out}
    texts = {r.doc_id: re.sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in docs.collect()}
    # Of equal texts at most one stays, and clean documents are kept unless an equal or near one is.
    assert all(n == 1 for n in Counter(texts[i] for i in kept).values())
    clean = [i for i in texts if labels.get(i) == 0]
    assert sum(any(texts[j] == texts[i] for j in kept) for i in clean) > 0.9 * len(clean)
