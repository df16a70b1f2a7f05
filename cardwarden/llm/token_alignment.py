"""Alignment of two tokenizers over the same texts: byte-level BPE (A) and pieces with byte fallback (B).

Where tokens of both end at one byte, a text is cut into groups; tokens whose byte ranges overlap are linked. Most
groups hold one token of each with the same bytes, and for those a table from A's ids to the same-bytes ids of B is
made once: a task counts such groups in one vector as long as A's vocabulary and hands it on when it ends. Only the
links of all other groups are counted pair by pair and shuffled. A document's links get their corpus-wide counts
from the vector, from the ``KNOWN`` most frequent pairs (a fixed number of rows), and the rest by a join.

Missing and empty texts, and texts that one of the tokenizers does not reproduce byte by byte, have no tokens: zeros
and an empty digest, and no part in the counts. Repeated rows count as often as they occur; missing and repeated ids
keep their rows; ties are all a B id's best. An empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardwarden.llm.word_bpe import byte_symbols
from cardwarden.llm.words import slices
from cardwarden.session import settle_table

#: Pairs whose counts every task knows: 8 MB.
KNOWN = 500_000
#: What a byte-level pre-tokenizer cuts by (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text tokenized at a time.
SLICE = 1 << 20


def encoder(a_json: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of texts by a ``tokenizer.json``, special strings being plain text.

    Of a byte-level BPE whose merges rank in the order of their ids, tiktoken gives the same ids in a quarter of the time;
    all others are left to the file's own library.
    """
    spec = json.loads(a_json)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    vocab, symbol = model["vocab"], byte_symbols()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    plain = (
        spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        and sorted(vocab.get(c, -1) for c in symbol) == list(range(256))
        and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(vocab) == 256 + len(merges)
    )
    if plain:
        ranks = {bytes(symbol[c] for c in token): i for token, i in vocab.items()}
        fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: list(map(fast.encode_ordinary, texts))
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    library = Tokenizer.from_str(a_json)
    library.encode_special_tokens = True
    return lambda texts: [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the same-bytes table (-1: none)."""

    def __init__(self, a_json: str, b_model: bytes):
        self._encode_a = encoder(a_json)
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        symbol = byte_symbols()
        vocab = json.loads(a_json)["model"]["vocab"]
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(symbol[c] for c in token)
        b_bytes = [self._piece_bytes(i) for i in range(self._b.vocab_size())]
        self.n_a, self.n_b = len(a_bytes), len(b_bytes)
        of_bytes: dict[bytes, int] = {}
        for i in sorted(range(self.n_b), key=self._b.is_byte):  # whole pieces before single bytes
            if b_bytes[i]:
                of_bytes.setdefault(b_bytes[i], i)
        self.same = np.array([of_bytes.get(x, -1) if x else -1 for x in a_bytes], np.int64)
        self._sizes = [np.array(list(map(len, x)), np.int64) for x in (a_bytes, b_bytes)]
        self._bytes = [pa.array(x, pa.binary()) for x in (a_bytes, b_bytes)]
        # What an id looks like in a group's text, by what stands behind it.
        a_text, b_text = ([str(i) for i in range(n)] for n in (self.n_a, self.n_b))
        self._shown = pa.array(
            [t + "," for t in a_text] + [t + "|" for t in a_text] + [t + x for x in (",", ";", "") for t in b_text], pa.string()
        )

    def _piece_bytes(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        if self._b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self._b.is_control(i) or self._b.is_unknown(i) else piece.replace("▁", " ").encode()

    def align(self, texts: pa.Array) -> Alignment:
        """``texts``: strings without nulls."""
        plain = texts.to_pylist()
        a = self._encode_a([" " + t if t else "" for t in plain])
        b = self._b.encode(plain, num_threads=1)
        want = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
        want = want.cast(pa.large_binary())
        good = pc.not_equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        sides = []
        for lists, sizes, bytes_ in zip((a, b), self._sizes, self._bytes):
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter((i for x in lists for i in x), np.int64, int(n.sum()))
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, bytes_.take(pa.array(ids))), pa.scalar(b"", pa.binary()))
            good &= pc.equal(joined.cast(pa.large_binary()), want).to_numpy(zero_copy_only=False)
            sides.append((ids, n, sizes))
        kept = []
        for ids, n, sizes in sides:
            ids = ids[np.repeat(good, n)]
            kept += [ids, np.where(good, n, 0), np.cumsum(sizes[ids])]
        return Alignment(*kept)


@dataclass
class Alignment:
    """Tokens of a batch of texts: ids, number per text, and the byte behind each, counted through the batch."""

    a: np.ndarray
    n_a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    n_b: np.ndarray
    b_ends: np.ndarray

    def __post_init__(self) -> None:
        a_closes, b_closes = _found(self.a_ends, self.b_ends), _found(self.b_ends, self.a_ends)
        #: Group of each token.
        self.a_group, self.b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        self.a_closes, self.b_closes = a_closes, b_closes
        groups = int(a_closes.sum())
        self.a_in = np.bincount(self.a_group, minlength=groups)
        self.b_in = np.bincount(self.b_group, minlength=groups)
        before = np.concatenate([[0], np.cumsum(a_closes)])
        self.n_groups = np.diff(before[np.concatenate([[0], np.cumsum(self.n_a)])])
        # Both sides cut the bytes; each part between neighbouring cuts is one overlap.
        self.n_links = self.n_a + self.n_b - self.n_groups

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the linked tokens on both sides, in order, and the text of each link."""
        cuts = np.union1d(self.a_ends, self.b_ends)
        text = np.repeat(np.arange(len(self.n_links)), self.n_links)
        return np.searchsorted(self.a_ends, cuts), np.searchsorted(self.b_ends, cuts), text


def _found(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    if not len(y):
        return np.zeros(len(x), bool)
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def group_digests(vocabularies: Vocabularies, batch: Alignment) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each text; empty without tokens."""
    v, total = vocabularies, len(batch.a) + len(batch.b)
    b_before = np.concatenate([[0], np.cumsum(batch.b_in)])
    a_until = np.cumsum(batch.a_in)
    shown = np.zeros(total, np.int64)
    shown[np.arange(len(batch.a)) + b_before[batch.a_group]] = batch.a + v.n_a * batch.a_closes
    behind = batch.b_closes.astype(np.int64)
    behind[np.cumsum(batch.n_b)[batch.n_b > 0] - 1] = 2
    shown[np.arange(len(batch.b)) + a_until[batch.b_group]] = batch.b + 2 * v.n_a + v.n_b * behind
    bounds = np.concatenate([[0], np.cumsum(batch.n_a + batch.n_b)]).astype(np.int32)
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), v._shown.take(pa.array(shown))), "")
    return [hashlib.sha256(x.as_buffer()).hexdigest() if n else "" for x, n in zip(lines, batch.n_a.tolist())]


# --------------------------------------------------------------------------- tasks
@functools.lru_cache(maxsize=2)
def _load(a_json: str, b_model: bytes) -> Vocabularies:
    return Vocabularies(a_json, b_model)


def _read(spark, a_json: str, b_model: str) -> tuple[Broadcast, Vocabularies]:
    with open(a_json, encoding="utf-8") as f, open(b_model, "rb") as g:
        files = f.read(), g.read()
    return spark.sparkContext.broadcast(files), _load(*files)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows, docs.schema[id_col].dataType.simpleString()


def aligned_tokens(docs: DataFrame, a_json: str, b_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, a_ids, a_groups, b_ids, b_groups)``: each text's tokens of both sides, and the number of the group
    (from 0) that each token belongs to."""
    shared, _ = _read(docs.sparkSession, a_json, b_model)
    rows, kind = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = _load(*shared.value)
        for batch in slices(batches, "text", SLICE):
            found = vocabularies.align(batch.column(1))
            first = np.cumsum(found.n_groups) - found.n_groups
            columns = [batch.column(0)]
            for ids, n, group in ((found.a, found.n_a, found.a_group), (found.b, found.n_b, found.b_group)):
                columns += [_lists(ids, n, pa.int32()), _lists(group - np.repeat(first, n), n, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "a_ids", "a_groups", "b_ids", "b_groups"])

    schema = f"id {kind}, a_ids array<int>, a_groups array<int>, b_ids array<int>, b_groups array<int>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _lists(values: np.ndarray, n: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind.to_pandas_dtype())))


def _distinct(text: np.ndarray, key: np.ndarray, size: int, texts: int, kind: pa.DataType) -> tuple[pa.Array, pa.Array]:
    """Distinct keys (below ``size``) of each text and how often each occurs, as two columns of lists."""
    found, times = np.unique(text * size + key, return_counts=True)
    n = np.bincount(found // size, minlength=texts)
    return _lists(found % size, n, kind), _lists(times, n, pa.int32())


def linked_documents(docs: DataFrame, shared: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """One row per document with its numbers and its distinct links: ``same_ids`` (A's id of one-to-one groups with the
    same bytes) and ``pairs`` (``a * n_b + b``), each with how often they occur. ``(part, place)`` names a row."""
    rows, kind = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _load(*shared.value)
        part, place = uuid.uuid4().hex, 0
        for batch in slices(batches, "text", SLICE):
            found, texts = v.align(batch.column(1)), batch.num_rows
            at_a, at_b, text = found.links()
            a, b, group = found.a[at_a], found.b[at_b], found.a_group[at_a]
            regular = (found.a_in[group] == 1) & (found.b_in[group] == 1) & (v.same[a] == b)
            same = _distinct(text[regular], a[regular], v.n_a, texts, pa.int32())
            pairs = _distinct(text[~regular], (a * v.n_b + b)[~regular], v.n_a * v.n_b, texts, pa.int64())
            numbers = (pa.array(x.astype(np.int64)) for x in (found.n_a, found.n_b, found.n_groups, found.n_links))
            names = pa.array(group_digests(v, found), pa.string())
            row = [pa.array([part] * texts, pa.string()), pa.array(np.arange(place, place + texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, names, *same, *pairs, *row],
                ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same_ids", "same_n", "pairs", "pair_n", "part", "place"],
            )
            place += texts

    return rows.mapInArrow(
        run,
        f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, same_ids array<int>, "
        "same_n array<int>, pairs array<bigint>, pair_n array<int>, part string, place bigint",
    )


def link_totals(linked: DataFrame, n_a: int, n_b: int, same: np.ndarray) -> DataFrame:
    """``(pair, n)``: how often the corpus links A's id ``pair div n_b`` with B's id ``pair % n_b``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(n_a, np.int64)
        for batch in batches:
            ids, times, pairs, pair_times = (batch.column(i).flatten().to_numpy() for i in range(4))
            vector += np.bincount(ids, times, n_a).astype(np.int64)
            pairs, at = np.unique(pairs, return_inverse=True)
            sums = np.bincount(at, pair_times, len(pairs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(sums)], ["pair", "n"])
        some = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(some * n_b + same[some]), pa.array(vector[some])], ["pair", "n"])

    counted = linked.select("same_ids", "same_n", "pairs", "pair_n").mapInArrow(count, "pair bigint, n bigint")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def align_documents(docs: DataFrame, a_json: str, b_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per document.

    A link's count is how many links of the corpus hold its two ids; it is best if no other count of its B id is higher.
    """
    spark = docs.sparkSession
    shared, v = _read(spark, a_json, b_model)
    n_a, n_b, same = v.n_a, v.n_b, v.same
    linked = settle_table(linked_documents(docs, shared, id_col, text_col), "linked")
    totals = settle_table(link_totals(linked, n_a, n_b, same), "link-totals")
    best = np.zeros(n_b, np.int64)
    by_b = totals.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("n")).toArrow()  # a row per B id at most
    best[by_b.column("b").to_numpy()] = by_b.column("n").to_numpy()

    def regular(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column(0).to_numpy()
            yield batch.filter(pa.array(same[pair // n_b] == pair % n_b))

    vector = np.zeros(n_a, np.int64)
    by_a = totals.mapInArrow(regular, "pair bigint, n bigint").toArrow()  # a row per A id at most
    vector[by_a.column("pair").to_numpy() // n_b] = by_a.column("n").to_numpy()
    top = totals.orderBy(F.desc("n"), "pair").limit(KNOWN).toArrow()
    order = np.argsort(top.column("pair").to_numpy())
    known = tuple(top.column(c).to_numpy()[order] for c in ("pair", "n"))
    counts = spark.sparkContext.broadcast((best, vector, known))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, vector, (pairs, numbers) = counts.value
        for batch in batches:
            rows = batch.num_rows
            sums, bests = np.zeros(rows, np.int64), np.zeros(rows, np.int64)

            def add(owner: np.ndarray, count: np.ndarray, b: np.ndarray, times: np.ndarray) -> None:
                np.add.at(sums, owner, count * times)
                np.add.at(bests, owner, (count == best[b]) * times)

            def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
                lists = batch.column(name)
                return np.repeat(np.arange(rows), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy().astype(np.int64)

            (owner, ids), (_, times) = flat("same_ids"), flat("same_n")
            add(owner, vector[ids], same[ids], times)
            (owner, pair), (_, times) = flat("pairs"), flat("pair_n")
            at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            here = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            add(owner[here], numbers[at[here]], pair[here] % n_b, times[here])
            there = ~here
            rest = pa.StructArray.from_arrays(
                [pa.array(pair[there]), pa.array(times[there]), pa.array(best[pair[there] % n_b])], ["pair", "times", "best"]
            )
            starts = np.searchsorted(owner[there], np.arange(rows + 1)).astype(np.int32)
            keep = [batch.column(c) for c in names]
            more = [pa.array(bests), pa.array(sums), pa.ListArray.from_arrays(pa.array(starts), rest)]
            yield pa.RecordBatch.from_arrays([*keep, *more], [*names, "n_best", "count_sum", "rest"])

    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "part", "place"]
    kind = docs.schema[id_col].dataType.simpleString()
    partly = settle_table(
        linked.select(*names, "same_ids", "same_n", "pairs", "pair_n").mapInArrow(
            look_up,
            f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, part string, place bigint, "
            "n_best bigint, count_sum bigint, rest array<struct<pair: bigint, times: bigint, best: bigint>>",
        ),
        "aligned",
    )
    rest = partly.select("part", "place", F.explode("rest").alias("r")).select("part", "place", "r.*").join(totals, "pair")
    sums = rest.groupBy("part", "place").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    return partly.join(sums, ["part", "place"], "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )


def translation(totals: DataFrame, n_b: int) -> DataFrame:
    """``(b_id, a_id, n)``: the A id that each B id is linked with most often, the smallest of equals."""
    pairs = totals.select((F.col("pair") % n_b).alias("b_id"), F.expr(f"pair div {n_b}").alias("a_id"), "n")
    first = pairs.groupBy("b_id").agg(F.max_by(F.struct("a_id", "n"), F.struct("n", -F.col("a_id"))).alias("x"))
    return first.select("b_id", "x.a_id", "x.n")
