"""Byte-level BPE in Spark's higher-order functions.

Texts are cut by the vocabulary's pattern. Distinct pieces of a task are sequences of byte symbols (one
printable character per byte); a fold over the ranked merges that a piece allows, lowest rank first, joins its
symbols to tokens. Ranks are one literal: an array of small maps, addressed by a hash, since looking up a key
in one large Spark map is linear. Ids go back to the texts by the pieces' numbers; decoding concatenates the
binary pieces of the ids. No text is shuffled: a task numbers its pieces, folds those it has not folded before,
and puts its texts together, batch by batch. The ``KNOWN`` most frequent pieces of some ``SEEN`` rows are folded once,
by the same fold, and broadcast; which pieces these are influences time, never a result.

Missing and empty texts have no ids and decode to nothing. Rows are independent: repeated rows, ties and missing
ids pass through; an empty table gives an empty table. Pieces above ``LONG`` bytes, for which the fold's quadratic
work would not end, are encoded by tiktoken inside the task, with the same result. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.word_bpe import byte_symbols
from cardwarden.llm.words import slices

LONG = 512
#: Pieces a task keeps before it starts numbering anew; only time depends on it.
KEPT = 400_000
#: Pieces folded before, and rows whose pieces are counted for that.
KNOWN = 600_000
SEEN = 32_000
BUCKETS = 1 << 14
#: Bytes of a word whose borders fit in a long.
BITS = 60
#: Symbols that tell how long a token beginning with them can be, and slots for that.
HEAD = 4
HEADS = 1 << 16
SLICE = 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


def rank_literal(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """``array<map<string, int>>``: the map at ``hash(symbols) & (BUCKETS - 1)`` has the rank of the symbols."""
    symbol = {b: c for c, b in byte_symbols().items()}
    names = pa.table({"name": ["".join(symbol[b] for b in t) for t in ranks], "rank": list(ranks.values())})
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    placed = spark.createDataFrame(names).select("name", "rank", _bucket(F.col("name")).alias("bucket"))
    for row in placed.toArrow().to_pylist():
        buckets[row["bucket"]][row["name"]] = row["rank"]
    return F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), "array<map<string,int>>")


def reach_literal(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """``array<int>``: at ``hash(first HEAD symbols) & (HEADS - 1)`` the bytes of the longest token that begins so. Heads
    that share a slot share the greater number, so that none is too small; slots of no token have ``HEAD - 1``."""
    heads: dict[bytes, int] = {}
    for token in ranks:
        if len(token) >= HEAD:
            heads[token[:HEAD]] = max(len(token), heads.get(token[:HEAD], 0))
    names = pa.table({"name": _symbols(list(heads)), "size": pa.array(heads.values(), pa.int32())})
    reach = [HEAD - 1] * HEADS
    for row in spark.createDataFrame(names).select("size", _slot(F.col("name")).alias("slot")).toArrow().to_pylist():
        reach[row["slot"]] = max(reach[row["slot"]], row["size"])
    return F.from_json(F.lit(json.dumps(reach)), "array<int>")


def _bucket(symbols: Column) -> Column:
    return F.hash(symbols).bitwiseAND(BUCKETS - 1)


def _slot(head: Column) -> Column:
    return F.hash(head).bitwiseAND(HEADS - 1)


def part_sizes(word: Column, i: Column, n: Column, reach: Column) -> Column:
    """Bytes of the parts that begin at byte ``i`` of a word of ``n`` and can be tokens."""
    return F.sequence(F.lit(2), F.least(n - i, F.get(reach, _slot(F.substr(word, i + 1, F.lit(HEAD))))))


def _masks() -> tuple[Column, Column]:
    """``array<bigint>``, at ``begin * 64 + end`` of a part: the bits of both ends, and of all places between them."""
    places = [(i >> 6, min(i & 63, BITS)) for i in range(BITS << 6)]
    ends = [1 << begin | 1 << end for begin, end in places]
    between = [max(0, (1 << end) - (2 << begin)) for begin, end in places]
    return tuple(F.from_json(F.lit(json.dumps(m)), "array<bigint>") for m in (ends, between))


def in_order(ranks: dict[bytes, int]) -> bool:
    """Whether each token comes, from its bytes, out of merges that all rank before it. Then merges taken once in
    the order of their ranks are the encoding: no later merge can make room for an earlier one."""
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            low, at = min(((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if low >= rank:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return True


def fold_merges(words: Column, ranks: Column, reach: Column, ordered: bool = True) -> Column:
    """``array<array<int>>``: the ids of each word, a word being a string of byte symbols.

    Words up to ``BITS`` bytes: all their parts with a rank are sorted by it, and a fold over them keeps the borders
    between tokens as the bits of a number: a part is merged if just one border is left inside it and its ends
    are borders. ``reach``: see :func:`reach_literal`. Longer words, and all if the ranks are not ``ordered``
    (see :func:`in_order`), fold an array of parts, the lowest adjacent pair first.
    """
    one = F.lit(1)

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def with_tables(table: Column, reach: Column, ends: Column, between: Column) -> Column:
        def rank(x: Column) -> Column:
            return F.try_element_at(F.get(table, _bucket(x)), x)

        def bit(n: Column) -> Column:
            return F.call_function("shiftleft", F.lit(1).cast("long"), n)

        def by_borders(word: Column, n: Column) -> Column:
            def parts_at(i: Column) -> Column:
                texts = F.transform(part_sizes(word, i, n, reach), lambda size: F.substr(word, i + 1, size))
                return F.transform(texts, lambda x, j: rank(x).cast("long") * 4096 + (i * 65 + j + 2))

            parts = F.transform(F.sequence(F.lit(0), n - 2), parts_at)

            def merge(borders: Column, code: Column) -> Column:
                # ``code``: rank, first byte and byte behind the part, which are the masks' index.
                at = code.bitwiseAND(4095).cast("int")
                inside = F.get(between, at)
                fits = (F.bitwise_not(borders).bitwiseAND(F.get(ends, at)) == 0) & (F.bit_count(borders.bitwiseAND(inside)) == 1)
                return F.when(fits, borders.bitwiseAND(F.bitwise_not(inside))).otherwise(borders)

            borders = F.aggregate(F.sort_array(F.array_compact(F.flatten(parts))), bit(n + 1) - 1, merge)

            def tokens(borders: Column) -> Column:
                starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: borders.bitwiseAND(bit(i)) != 0)
                return let(starts, lambda s: F.transform(s, lambda i, j: rank(F.substr(word, i + 1, F.coalesce(F.get(s, j + 1), n) - i))))

            return let(borders, tokens)

        def state(parts: Column, pairs: Column) -> Column:
            """The parts, between missing ends, the rank of each adjacent pair, and the place of the lowest."""
            return F.struct(parts.alias("p"), pairs.alias("r"), F.array_position(pairs, F.array_min(pairs)).cast("int").alias("i"))

        def merge_lowest(acc: Column, _: Column) -> Column:
            p, r, i = acc["p"], acc["r"], acc["i"]

            def joined(new: Column) -> Column:
                parts = F.concat(F.slice(p, one, i - 1), F.array(new), F.slice(p, i + 2, F.size(p)))
                beside = F.array(rank(F.concat(F.get(p, i - 2), new)), rank(F.concat(new, F.get(p, i + 1))))
                pairs = F.concat(F.slice(r, one, i - 2), beside, F.slice(r, i + 2, F.size(r)))
                return let(pairs, lambda q: state(parts, q))

            return F.when(i.isNull(), acc).otherwise(let(F.concat(F.get(p, i - 1), F.get(p, i)), joined))

        def by_parts(text: Column) -> Column:
            def fold(word: Column) -> Column:
                ends = F.array(F.lit(None).cast("string"))
                none = F.array(F.lit(None).cast("int"))
                pairs = F.transform(word, lambda x, j: rank(F.concat(x, F.get(word, j + 1))))
                first = let(F.concat(none, pairs), lambda q: state(F.concat(ends, word, ends), q))
                return F.aggregate(
                    F.sequence(F.lit(2), F.size(word)), first, merge_lowest,
                    lambda acc: F.transform(F.slice(acc["p"], F.lit(2), F.size(acc["p"]) - 2), rank),
                )

            return let(F.filter(F.split(text, ""), lambda x: x != ""), fold)

        def encode(word: Column) -> Column:
            n = F.length(word)
            short = (n <= BITS) & F.lit(ordered)
            # A piece that is a token stays whole, as does a single byte.
            return let(
                rank(word),
                lambda w: F.when(w.isNotNull() | (n < 2), F.array(w)).when(short, by_borders(word, n)).otherwise(by_parts(word)),
            )

        return F.transform(words, encode)

    ends, between = _masks()
    return let(ranks, lambda t: let(reach, lambda r: let(ends, lambda e: let(between, lambda b: with_tables(t, r, e, b)))))


def _symbols(raw: list[bytes]) -> pa.Array:
    """Byte strings as strings of byte symbols."""
    symbols = pa.array([c for c, _ in sorted(byte_symbols().items(), key=lambda x: x[1])], pa.string())
    flat = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([0, *map(len, raw)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(ends, symbols.take(pa.array(flat))), "")


def frequent_pieces(texts: DataFrame, pattern: str, fold) -> tuple[pa.Array, pa.Array]:
    """The most frequent pieces of some rows of ``texts (text)``, and their ids by ``fold(array of words)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        for batch in slices(batches, "text", SLICE):
            counts = Counter(chain.from_iterable(map(find, batch.column(1).to_pylist())))
            names = [p for p in counts if len(p.encode()) <= BITS]
            times = pa.array([counts[p] for p in names], pa.int64())
            words = _symbols([p.encode() for p in names])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), words, times], ["piece", "word", "n"])

    some = texts.sample(min(1.0, SEEN / max(1, texts.count())), 0).select(F.lit(0).alias("id"), "text")
    counts = some.mapInArrow(count, "piece string, word string, n bigint").groupBy("piece", "word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "piece").limit(KNOWN)
    spread = top.repartition(4 * texts.sparkSession.sparkContext.defaultParallelism)
    found = spread.select("piece", F.get(fold(F.array("word")), F.lit(0)).alias("ids")).toArrow().combine_chunks()
    pieces, ids = found.column("piece").cast(pa.string()), found.column("ids").cast(pa.list_(pa.int32()))
    return pa.concat_arrays([pa.array([], pa.string()), *pieces.chunks]), pa.concat_arrays([pa.array([], ids.type), *ids.chunks])


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, Broadcast]:
    """One row per batch of texts of a task, in order, for :func:`assemble`: the ids of the rows, the texts' pieces
    by number, and the ids of pieces that are new. Numbers begin with those of :func:`frequent_pieces`, broadcast."""
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema[id_col].dataType.simpleString()
    table, reach, ordered = rank_literal(docs.sparkSession, ranks), reach_literal(docs.sparkSession, ranks), in_order(ranks)

    def fold(words: Column) -> Column:
        return fold_merges(words, table, reach, ordered)

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pieces(rows.select("text"), pattern, fold))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        library = None
        before = frequent.value[0]
        numbers: dict[str, int] = {}
        fresh = True
        for batch in slices(batches, "text", SLICE):
            if len(numbers) > KEPT:
                numbers, fresh = {}, True
            pieces, bounds = [], np.zeros(batch.num_rows + 1, np.int32)
            for i, text in enumerate(batch.column(1).to_pylist()):
                pieces += find(text)
                bounds[i + 1] = len(pieces)
            coded = pa.array(pieces, pa.string()).dictionary_encode()
            known = pc.fill_null(pc.index_in(coded.dictionary, value_set=before), -1).to_numpy().astype(np.int64)
            rest = np.flatnonzero(known < 0)
            distinct = coded.dictionary.take(pa.array(rest)).to_pylist()
            new = [w for w in distinct if w not in numbers]
            raw = [w.encode() for w in new]
            short = [(w, r) for w, r in zip(new, raw) if len(r) <= LONG]
            long = [(w, r) for w, r in zip(new, raw) if len(r) > LONG]
            for word, _ in short + long:
                numbers[word] = len(before) + len(numbers)
            if long and library is None:
                library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
            long_ids = [library.encode_ordinary(w) for w, _ in long]
            known[rest] = np.fromiter(map(numbers.get, distinct), np.int64, len(distinct))
            codes = known[coded.indices.to_numpy()] if len(pieces) else np.zeros(0, np.int64)
            words = _symbols([r for _, r in short])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([fresh]), _row(batch.column(0)), _row(pa.array(bounds)), _row(pa.array(codes.astype(np.int32))),
                    _row(words), pa.array([long_ids], pa.list_(pa.list_(pa.int32()))),
                ],
                ["fresh", "ids", "bounds", "codes", "words", "long"],
            )
            fresh = False

    numbered = rows.mapInArrow(
        number,
        f"fresh boolean, ids array<{kind}>, bounds array<int>, codes array<int>, words array<string>, long array<array<int>>",
    )
    return numbered.select("fresh", "ids", "bounds", "codes", fold(F.col("words")).alias("tokens"), "long"), frequent


def _row(values: pa.Array) -> pa.Array:
    """All values as the list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _tasks_pieces(batches: Iterator[pa.RecordBatch], token_bytes: list[bytes], frequent: pa.Array):
    """For every row of :func:`encode`: ids of the rows, bounds, codes, and of all pieces numbered so far the
    ids' text, their bytes and their number."""
    texts, raws, sizes = [], [], []
    tokens = pa.array(token_bytes, pa.binary())

    def add(lists: pa.Array) -> None:
        flat = lists.flatten()
        texts.append(pc.binary_join(pa.ListArray.from_arrays(_offsets(lists), flat.cast(pa.string())), ","))
        pieces = tokens.take(flat)
        raws.append(pc.binary_join(pa.ListArray.from_arrays(_offsets(lists), pieces), pa.scalar(b"", pa.binary())))
        sizes.append(pc.list_value_length(lists))

    for batch in batches:
        for row in range(batch.num_rows):
            if batch.column("fresh")[row].as_py():
                texts, raws, sizes = [], [], []
                add(frequent)
            for name in ("tokens", "long"):
                lists = batch.column(name)[row].values
                if lists is not None and len(lists):
                    add(lists)
            if len(texts) > 1:
                texts, raws, sizes = ([pa.concat_arrays(x)] for x in (texts, raws, sizes))
            yield (
                batch.column("ids")[row].values, batch.column("bounds")[row].values.to_numpy(),
                batch.column("codes")[row].values, texts, raws, sizes,
            )


def _offsets(lists: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int32))


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: each text encoded and decoded again."""
    kind = docs.schema[id_col].dataType.simpleString()
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast([t for t, _ in sorted(ranks.items(), key=lambda x: x[1])])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bounds, codes, texts, raws, sizes in _tasks_pieces(batches, shared.value, frequent.value[1]):
            starts = pa.array(bounds)
            if texts and len(codes):
                id_texts = pc.binary_join(pa.ListArray.from_arrays(starts, texts[0].take(codes)), ",")
                decoded = pc.binary_join(
                    pa.ListArray.from_arrays(starts, raws[0].take(codes)), pa.scalar(b"", pa.binary())
                )
                counts = np.concatenate([[0], np.cumsum(sizes[0].take(codes).to_numpy())])[bounds]
                n_tokens = np.diff(counts).astype(np.int64)
            else:
                id_texts = pa.array([""] * len(ids))
                decoded, n_tokens = pa.array([b""] * len(ids)), np.zeros(len(ids), np.int64)
            sha = [[hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in column] for column in (id_texts, decoded)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_tokens), pa.array(sha[0], pa.string()), pa.array(sha[1], pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    coded, frequent = encode(docs, ranks_path, pattern, id_col, text_col)
    out = coded.mapInArrow(assemble, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def encode_ids(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)``"""
    kind = docs.schema[id_col].dataType.simpleString()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [frequent.value[1]]
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("fresh")[row].as_py():
                    pieces = [frequent.value[1]]
                new = [batch.column(n)[row].values for n in ("tokens", "long")]
                pieces = [pa.concat_arrays([*pieces, *(x for x in new if x is not None and len(x))])]
                codes, bounds = batch.column("codes")[row].values, batch.column("bounds")[row].values.to_numpy()
                ids = batch.column("ids")[row].values
                if len(codes):
                    lists = pieces[0].take(codes)
                    at = _offsets(lists).to_numpy()[bounds].astype(np.int32)
                    out = pa.ListArray.from_arrays(pa.array(at), lists.flatten().cast(pa.int32()))
                else:
                    out = pa.array([[]] * len(ids), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, out], ["id", "ids"])

    coded, frequent = encode(docs, ranks_path, pattern, id_col, text_col)
    return coded.mapInArrow(assemble, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids: their binary pieces one after the other; a missing array stays missing."""
    tokens = [base64.b64encode(t).decode() for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    literal = F.from_json(F.lit(json.dumps(tokens)), "array<string>")
    empty = F.lit(b"")

    def with_table(table: Column) -> Column:
        return F.aggregate(ids, empty, lambda done, i: F.concat(done, F.unbase64(F.get(table, i))))

    return F.get(F.transform(F.array(literal), with_table), F.lit(0))
