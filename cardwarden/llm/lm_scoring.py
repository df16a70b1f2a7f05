"""Log probabilities of texts by a log-bilinear neural model.

Tokens are words (A-Z in lower case) and one end per text. Counts of all training tokens are taken over the whole
corpus. The model predicts classes: the most frequent words, the end, and, for all other words, one class for each
group of last letters; a word inside such a class has its smoothed share of the class. A class's probability after
the ``CONTEXT`` classes before it is log-bilinear: the context's vectors, each through the matrix of its place, add
up to a predicted vector, whose products with the classes' vectors are normalised over all classes, by blocks of
tokens as one matrix product. It is trained in numpy by noise-contrastive estimation, the noise being the classes'
corpus frequencies, on all training texts: tasks train copies of the model on some ``fit_tokens`` tokens or more each,
and the copies are averaged after every round.

Counts reach the texts in two ways: those of the ``KNOWN`` most frequent words are broadcast (a fixed number of
rows), all others are joined, word by word, to the words that the texts hold besides.

Missing and empty texts hold just the end. Missing ids belong to the training texts. Repeated rows count and are
scored as often as they occur. Without training texts every token has probability one in its class. An empty
table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import copy
import functools
import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.words import Words, slices, split_words, spread
from cardwarden.session import settle_table

END = "\n"  # no word holds white space
KNOWN = 100_000
FREQUENT = 447
ENDINGS = 64
CLASSES = FREQUENT + 1 + ENDINGS
CONTEXT = 3
SLICE = 4 << 20  # larger slices share more contexts
WIDTH = 16
ROUNDS = 3  # of the pass over the training texts


@functools.lru_cache(65_536)
def _ending(letters: str) -> int:
    return FREQUENT + 1 + zlib.crc32(letters.encode()) % ENDINGS


def ending_class(words: pa.Array) -> np.ndarray:
    """Classes of words by their last letters, each distinct ending hashed once."""
    coded = pc.utf8_slice_codeunits(words, -2).dictionary_encode()
    classes = np.fromiter(map(_ending, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    return classes[coded.indices.to_numpy()]


def _remainder(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5


def training_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` over all rows of ``docs (text)``, their ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = split_words(batch.column(1), lower=True)
            counts = np.bincount(words.codes, minlength=len(words.distinct))
            names = pa.concat_arrays([words.distinct.cast(pa.string()), pa.array([END])])
            yield pa.RecordBatch.from_arrays([names, pa.array(np.append(counts, batch.num_rows))], ["word", "n"])

    rows = docs.select(F.lit(0).alias("id"), "text")
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Known:
    """Frequent words, most frequent first, with their counts; the first ``FREQUENT`` are classes of their own."""

    words: pa.Array
    counts: np.ndarray

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Counts (-1: not in the list) and classes of words."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        classes = np.where((at >= 0) & (at < FREQUENT), at, ending_class(words))
        return np.append(self.counts, -1)[at], classes


@dataclass
class Vocabulary:
    """Sums over all training tokens, and the bounded list of frequent words."""

    tokens: int
    distinct: int
    known: Known
    class_counts: np.ndarray
    class_distinct: np.ndarray


def vocabulary(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    top = counts.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(KNOWN).toArrow()
    words, numbers = top.column("word").to_pylist(), top.column("n").to_pylist()
    known = Known(pa.array(words, pa.large_string()), np.array(numbers, np.int64))
    suffix = F.expr("crc32(cast(substring(word, -2, 2) as binary))") % ENDINGS
    rest = (
        counts.where((F.col("word") != END) & ~F.col("word").isin(words[:FREQUENT]))
        .groupBy(suffix.alias("ending"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("v"))
        .collect()
    )
    class_counts, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    class_counts[: min(FREQUENT, len(words))] = numbers[:FREQUENT]
    end = counts.where(F.col("word") == END).first()
    class_counts[FREQUENT] = end["n"] if end else 0
    for r in rest:
        class_counts[FREQUENT + 1 + r["ending"]] = r["n"]
        class_distinct[FREQUENT + 1 + r["ending"]] = r["v"]
    return Vocabulary(int(totals["n"] or 0), int(totals["v"]), known, class_counts, class_distinct)


def class_sequences(words: Words, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all tokens, each text closed by its end, and the bounds of the texts."""
    n = np.diff(words.bounds)
    ends = words.bounds[1:]
    return np.insert(classes[words.codes], ends, FREQUENT), np.concatenate([[0], np.cumsum(n + 1)])


def contexts(sequence: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The ``CONTEXT`` classes before each token, nearest first; ``CLASSES`` stands before a text."""
    place = spread(np.zeros(len(bounds) - 1, np.int64), np.diff(bounds))
    out = np.full((CONTEXT, len(sequence)), CLASSES, np.int64)
    for j in range(CONTEXT):
        out[j, j + 1 :] = sequence[: len(sequence) - j - 1]
        out[j, place <= j] = CLASSES
    return out


# --------------------------------------------------------------------------- the model
@dataclass
class LogBilinear:
    inputs: np.ndarray  # (CLASSES + 1, WIDTH)
    places: np.ndarray  # (CONTEXT, WIDTH, WIDTH)
    outputs: np.ndarray  # (CLASSES, WIDTH)
    bias: np.ndarray

    def log10(self, context: np.ndarray, target: np.ndarray, block: int = 512) -> np.ndarray:
        """Normalised log10 probabilities of the targets. The normaliser depends on the context alone, so it is
        taken once for each distinct context."""
        tables = np.einsum("cw,pwv->pcv", self.inputs, self.places).astype(np.float32)
        base = np.int64(CLASSES + 1)
        key = context[0].copy()
        for j in range(1, CONTEXT):
            key = key * base + context[j]
        distinct, which = np.unique(key, return_inverse=True)
        parts = [distinct // base ** (CONTEXT - 1 - j) % base for j in range(CONTEXT)]
        # A constant component carries the bias through the products.
        predicted = np.ones((len(distinct), WIDTH + 1), np.float32)
        predicted[:, :-1] = sum(tables[j][parts[j]] for j in range(CONTEXT))
        outputs = np.column_stack([self.outputs, self.bias]).astype(np.float32)
        # What each place, and the bias last, adds to the logits, around the middle of its range.
        added = [*(tables @ self.outputs.T), self.bias[None]]
        middle = [(x.max(1, keepdims=True) + x.min(1, keepdims=True)) / 2 for x in added]
        added = [x - m for x, m in zip(added, middle)]
        if sum(np.abs(x).max() for x in added) < 80:  # no product of exponentials leaves single precision
            total = self._by_places([np.exp(x).astype(np.float32) for x in added], parts, block) + middle[-1][0]
            total += sum(m[p, 0] for m, p in zip(middle, parts))
        else:
            total = self._by_logits(predicted, outputs, block)
        own = np.zeros(len(target))
        for at in range(0, len(target), 1 << 16):
            some = slice(at, at + (1 << 16))
            own[some] = np.einsum("nw,nw->n", predicted[which[some]], outputs[target[some]])
        return (own - total[which]) / np.log(10)

    def _by_places(self, factors: list[np.ndarray], parts: list[np.ndarray], block: int) -> np.ndarray:
        """Logarithms of the normalisers. The exponential of a logit is the product of those of its places, which are
        taken once for each class; contexts are sorted, so the nearest class and the bias go into a whole table."""
        *places, bias = factors
        total = np.zeros(len(parts[0]))
        for nearest, begin, end in _runs(parts[0]):
            row = places[0][nearest] * bias[0]
            table = places[2] * row if end - begin > CLASSES else None
            for at in range(begin, end, block):
                some = slice(at, min(at + block, end))
                rows = places[2][parts[2][some]] * row if table is None else table[parts[2][some]]
                total[some] = np.einsum("nv,nv->n", rows, places[1][parts[1][some]])
        return np.log(total)

    def _by_logits(self, predicted: np.ndarray, outputs: np.ndarray, block: int) -> np.ndarray:
        """The same for logits of any size: the largest goes before the exponential."""
        total = np.zeros(len(predicted))
        for at in range(0, len(predicted), block):
            logits = predicted[at : at + block] @ outputs.T
            top = logits.max(1, keepdims=True)
            total[at : at + block] = np.log(np.exp(logits - top).sum(1, dtype=np.float64)) + top[:, 0]
        return total


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """``(value, begin, end)`` of the runs of equal values."""
    begins = np.flatnonzero(np.diff(values, prepend=-1)).tolist()
    return list(zip(values[begins].tolist(), begins, [*begins[1:], len(values)]))


@dataclass
class Trainer:
    """A model and its sums of squared gradients, trained text by text; it goes to tasks and back as one vector."""

    model: LogBilinear
    power: list[np.ndarray]
    share: np.ndarray  # the noise

    def values(self) -> list[np.ndarray]:
        return [self.model.inputs, self.model.places, self.model.outputs, self.model.bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in [*self.values(), *self.power]])

    def unpack(self, vector: np.ndarray) -> None:
        at = 0
        for x in [*self.values(), *self.power]:
            x[...] = vector[at : at + x.size].reshape(x.shape)
            at += x.size

    def learn(
        self, sequence: np.ndarray, bounds: np.ndarray, rng: np.random.Generator, batch: int = 1024, noise: int = 128, rate: float = 0.05
    ) -> None:
        """One pass of noise-contrastive estimation with Adagrad; a batch shares its noise, so that it is matrix products."""
        context = contexts(sequence, bounds)
        offset, picks = np.log(noise * self.share).astype(np.float32), np.cumsum(self.share)
        order = rng.permutation(len(sequence))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            n, target, before = len(some), sequence[some], context[:, some]
            # Products in single, sums and parameters in double precision.
            inputs, places, outputs, bias = (x.astype(np.float32) for x in self.values())
            given = [inputs[before[j]] for j in range(CONTEXT)]
            predicted = sum(g @ places[j] for j, g in enumerate(given))
            false = np.minimum(np.searchsorted(picks, rng.random(noise)), CLASSES - 1)
            own = (predicted * outputs[target]).sum(1) + bias[target] - offset[target]
            other = predicted @ outputs[false].T + (bias - offset)[false]
            up = -1 / (1 + np.exp(np.clip(own, -30, 30)))  # d loss / d own
            down = 1 / (1 + np.exp(-np.clip(other, -30, 30)))
            d_predicted = up[:, None] * outputs[target] + down @ outputs[false]
            d_places = np.stack([g.T @ d_predicted for g in given]).astype(np.float64)
            back = np.concatenate([d_predicted @ places[j].T for j in range(CONTEXT)])
            d_inputs = _summed(before.ravel(), back, CLASSES + 1)
            d_outputs = _summed(np.append(target, false), np.concatenate([up[:, None] * predicted, down.T @ predicted]), CLASSES)
            d_bias = np.bincount(np.append(target, false), np.append(up, down.sum(0)), CLASSES)
            for value, gradient, sums in zip(self.values(), (d_inputs, d_places, d_outputs, d_bias), self.power):
                gradient /= n
                sums += gradient * gradient
                value -= rate * gradient / np.sqrt(sums)


def _summed(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of each place."""
    width = rows.shape[1]
    cells = (at[:, None] * width + np.arange(width)).ravel()
    return np.bincount(cells, rows.ravel(), size * width).reshape(size, width)


def trainer(class_counts: np.ndarray, seed: int = 0) -> Trainer:
    rng = np.random.default_rng(seed)
    share = (class_counts + 1.0) / (class_counts.sum() + CLASSES)
    model = LogBilinear(
        rng.normal(0, 0.1, (CLASSES + 1, WIDTH)), np.stack([np.eye(WIDTH) * 0.5**j for j in range(CONTEXT)]),
        rng.normal(0, 0.1, (CLASSES, WIDTH)), np.log(share),
    )
    # Mean gradients of a batch are small: sums that begin much above their squares would hold the steps back.
    power = [np.full_like(x, 1e-6) for x in (model.inputs, model.places, model.outputs, model.bias)]
    return Trainer(model, power, share)


def train(
    sequence: np.ndarray, bounds: np.ndarray, class_counts: np.ndarray, rounds: int = 3, batch: int = 1024,
    noise: int = 128, rate: float = 0.05, seed: int = 0,
) -> LogBilinear:
    """Noise-contrastive estimation over sequences that are in memory."""
    out, rng = trainer(class_counts, seed), np.random.default_rng(seed)
    for _ in range(rounds):
        out.learn(sequence, bounds, rng, batch, noise, rate)
    return out.model


def train_all(docs: DataFrame, words_: Vocabulary, fit_tokens: int) -> LogBilinear:
    """The model after all texts of ``docs (text)``, each of which it learns once, whatever their number: ``ROUNDS``
    rounds share them out by hash; in each, tasks train copies of the model on their part of the round's texts, and
    the copies' mean, weighted by tokens, goes to the next round."""
    state = trainer(words_.class_counts)
    tasks = max(1, -(-words_.tokens // (ROUNDS * max(1, fit_tokens))))
    groups = math.isqrt(tasks)
    context = docs.sparkSession.sparkContext
    for step in range(ROUNDS if words_.tokens else 0):
        part = docs.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == step)
        shared = context.broadcast((words_.known, state))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, state = shared.value
            state, seen = copy.deepcopy(state), 0
            task = TaskContext.get().partitionId()
            rng = np.random.default_rng([step, task])
            for batch in slices(batches, "text", SLICE):
                words = split_words(batch.column(1), lower=True)
                sequence, bounds = class_sequences(words, known.find(words.distinct)[1])
                state.learn(sequence, bounds, rng)
                seen += len(sequence)
            if seen:
                yield packed(task % groups, seen, state.packed() * seen)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, total = 0, 0.0
            for batch in batches:
                for n, vector in zip(batch.column(1).to_pylist(), batch.column(2)):
                    seen, total = seen + n, total + np.frombuffer(vector.as_buffer(), np.float64)
            if seen:
                yield packed(0, seen, total)

        def packed(group: int, seen: int, total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([group], pa.int32()), pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                ["group", "seen", "total"],
            )

        kind = "group int, seen bigint, total binary"
        copies = part.select(F.lit(0).alias("id"), "text").coalesce(tasks).mapInArrow(learn, kind)
        # Some 280 KB a task; the driver gets the sums of ``groups`` tasks, the square root of their number.
        sums = copies.repartition(groups, "group").mapInArrow(add, kind).collect()
        if sums:
            total = sum(np.frombuffer(r["total"], np.float64) for r in sums)
            state.unpack(total / sum(r["seen"] for r in sums))
        shared.unpersist()
    return state.model


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_tokens: int = 600_000, held_out: int = 1
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per document."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        (_remainder(id_col) == held_out).alias("held_out"),
    )
    training = rows.where(~F.col("held_out")).select("text")
    counts = settle_table(training_counts(training), "counts")
    words_ = vocabulary(counts)
    model = train_all(training, words_, fit_tokens)
    shared = docs.sparkSession.sparkContext.broadcast((words_, model))
    base_total = float(words_.tokens + 0.5 * (words_.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, model = shared.value
        part, place = uuid.uuid4().hex, 0
        end = words_.class_counts[FREQUENT]
        inside = np.log10(words_.class_counts + 0.5 * (words_.class_distinct + 1))
        for batch in slices(batches, "text", SLICE):
            words = split_words(batch.column(1), lower=True)
            found, classes = words_.known.find(words.distinct)
            sequence, bounds = class_sequences(words, classes)
            tokens = model.log10(contexts(sequence, bounds), sequence)
            rare = sequence > FREQUENT
            tokens[rare] -= inside[sequence[rare]]
            n = np.diff(words.bounds)
            text = np.repeat(np.arange(batch.num_rows), n)
            count = found[words.codes]
            here = count >= 0
            # Words outside the list get their counts by the join; here they add nothing yet.
            own = np.where(here, np.log10(np.maximum(count, 0) + 0.5), 0.0)
            base = np.bincount(text, own, batch.num_rows) + np.log10(end + 0.5) - (n + 1) * np.log10(base_total)
            total = np.add.reduceat(tokens, bounds[:-1])
            total += np.bincount(text, np.where(here & np.delete(rare, bounds[1:] - 1), own, 0.0), batch.num_rows)
            known = np.bincount(text, here, batch.num_rows).astype(np.int64) + (end > 0)
            missing = np.flatnonzero(~here)
            pairs, times = np.unique(text[missing] * len(found) + words.codes[missing], return_counts=True)
            owner, code = pairs // max(1, len(found)), pairs % max(1, len(found))
            starts = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            rest = pa.StructArray.from_arrays(
                [words.distinct.take(pa.array(code)).cast(pa.string()), pa.array(times.astype(np.int32))], ["word", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(n.astype(np.int64) + 1), pa.array(known), pa.array(base), pa.array(total),
                    pa.array([part] * batch.num_rows, pa.string()), pa.array(np.arange(place, place + batch.num_rows)),
                    pa.ListArray.from_arrays(pa.array(starts), rest),
                ],
                ["id", "held_out", "n_tokens", "known", "base", "total", "part", "place", "rest"],
            )
            place += batch.num_rows

    scored = settle_table(
        rows.mapInArrow(
            run,
            f"id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, total double, part string, "
            "place bigint, rest array<struct<word: string, times: int>>",
        ),
        "scored",
    )
    rest = scored.select("part", "place", F.explode("rest").alias("r")).select("part", "place", "r.word", "r.times")
    joined = rest.join(counts.withColumnRenamed("n", "count"), "word", "left").select(
        "part", "place", "times", F.coalesce("count", F.lit(0)).alias("count")
    )
    sums = joined.groupBy("part", "place").agg(
        F.sum(F.col("times") * F.log10(F.col("count") + 0.5)).alias("more"),
        F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("more_known"),
    )
    more = F.coalesce("more", F.lit(0.0))
    return (
        scored.drop("rest")
        .join(sums, ["part", "place"], "left")
        .select(
            F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(words_.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
            (F.col("total") + more).alias("score"),
        )
    )
