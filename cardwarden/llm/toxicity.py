"""Toxicity by a weighted finite-state grammar over clauses.

Five two-state transducers read the words of a clause as classes: insult, threat, target, negation and reported
speech. Their product (``compose``) has one state for each combination of what a clause has shown; the weights of
insults and threats add up along the way. A clause counts only when it matches, by its final state: directed at
somebody, plain, negated or reported. A text's features are the matched weights per kind of clause; a logistic
function turns them into a score.

Threats, targets, negations and reporting verbs are word lists. Insults are learned: words, and beginnings of
words, that labelled toxic texts have far more often than others, weighted by their log odds. Labels come from at
most ``fit_rows`` labelled rows (those with the smallest hash of the id; ids with ``crc32 % 5 == 0`` never); three
quarters of them give the insults, the others the weights of the features, so that chance finds get no trust.

Missing and empty texts have no clauses and a score like any other. Missing ids are held out. An id labelled
more than once counts as toxic if any label says so; missing labels are passed over. Repeated documents are scored
one by one. Without usable labels every score is 0. An empty table gives an empty table. Only the named columns
are read; others are handed on in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.words import WordCache, Words, slices, split_words

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Word classes that are not learned.
WORDS = {
    THREAT: "kill kills hurt destroy murder beat burn hang shoot stab tuer töten umbringen matar golpear frapper",
    TARGET: "you your you're yours u yourself he she him her they them tu toi vous ton te du dich dir euch ihr usted ustedes",
    NEGATION: "not never no isn't aren't wasn't don't doesn't didn't without ne pas jamais nicht kein keine nie nunca sin",
    REPORT: "said says told called calls quoted wrote claims alleged dit disait sagte sagt schrieb dijo dice llamó",
}
#: Lengths of word beginnings that can be learned.
BEGINNINGS = (3, 4, 5, 6, 7)
_LETTERS = regex.compile(r"\p{L}+(?:'\p{L}+)*")
_FEATURES = 10


# --------------------------------------------------------------------------- the grammar
@dataclass(frozen=True)
class Transducer:
    """``arcs[state][symbol] -> (next state, weight factor)``; ``finals``: the label of each state."""

    arcs: tuple[tuple[tuple[int, float], ...], ...]
    finals: tuple[tuple[str, ...], ...]


def latch(label: str, symbol: int, carries: bool) -> Transducer:
    """Remembers having seen ``symbol``; passes on that word's weight if it ``carries`` one."""
    seen = tuple((1 if s == symbol else 0, float(carries and s == symbol)) for s in range(6))
    stays = tuple((1, float(carries and s == symbol)) for s in range(6))
    return Transducer((seen, stays), ((), (label,)))


def compose(*machines: Transducer) -> Transducer:
    """All machines reading the same words; weights add up, labels gather."""
    states = list(product(*(range(len(m.arcs)) for m in machines)))
    index = {s: i for i, s in enumerate(states)}
    arcs = []
    for state in states:
        row = []
        for symbol in range(6):
            steps = [m.arcs[q][symbol] for m, q in zip(machines, state)]
            row.append((index[tuple(to for to, _ in steps)], sum(w for _, w in steps)))
        arcs.append(tuple(row))
    finals = tuple(tuple(x for m, q in zip(machines, s) for x in m.finals[q]) for s in states)
    return Transducer(tuple(arcs), finals)


GRAMMAR = compose(
    latch("insult", INSULT, True), latch("threat", THREAT, True), latch("target", TARGET, False),
    latch("negated", NEGATION, False), latch("reported", REPORT, False),
)


def _kind(labels: tuple[str, ...]) -> int:
    """0: no match, 1: directed, 2: plain, 3: negated, 4: reported insult, 5: threat at a target, 6: other threat."""
    if "insult" in labels:
        return 4 if "reported" in labels else 3 if "negated" in labels else 1 if "target" in labels else 2
    if "threat" in labels:
        return 5 if "target" in labels and "negated" not in labels and "reported" not in labels else 6
    return 0


def clause_features(words: Words, symbols: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Features of each text of a batch. ``symbols``, ``weights``, ``ends``: of each word occurrence; a clause
    ends behind a word with closing punctuation, at a line break and with the text."""
    n_texts = len(words.bounds) - 1
    counts = np.diff(words.bounds)
    text = np.repeat(np.arange(n_texts), counts)
    lines = np.cumsum(words.flat == 10)[words.starts] if len(words.starts) else np.zeros(0, np.int64)
    new = np.ones(len(text), bool)
    new[1:] = ends[:-1] | (np.diff(lines) > 0) | (np.diff(text) > 0)
    clause = np.cumsum(new) - 1
    some = np.flatnonzero(symbols)
    hit = np.unique(clause[some[symbols[some] <= THREAT]])
    some = some[np.isin(clause[some], hit)]
    out = np.zeros((n_texts, _FEATURES))
    out[:, 9] = np.log1p(counts)
    if not len(some):
        return out
    nodes, first, where = np.unique(clause[some], return_index=True, return_inverse=True)
    place = np.arange(len(some)) - first[where]
    to = np.array([[a for a, _ in row] for row in GRAMMAR.arcs])
    factor = np.array([[w for _, w in row] for row in GRAMMAR.arcs])
    state, total = np.zeros(len(nodes), np.int64), np.zeros(len(nodes))
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(place.max() + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        at = order[a:b]
        q, s = state[where[at]], symbols[some[at]]
        total[where[at]] += factor[q, s] * weights[some[at]]
        state[where[at]] = to[q, s]
    kind = np.array([_kind(labels) for labels in GRAMMAR.finals])[state]
    owner = text[some[first]]
    for k in range(1, 7):
        out[:, k - 1] = np.log1p(np.bincount(owner, np.where(kind == k, total, 0), n_texts))
    insults = np.bincount(owner, np.where((kind >= 1) & (kind <= 4), total, 0), n_texts)
    out[:, 6] = np.log1p(100 * insults / np.maximum(counts, 1))
    np.maximum.at(out[:, 7], owner, np.where(kind > 0, total, 0))
    out[:, 7] = np.log1p(out[:, 7])
    out[:, 8] = np.log1p(np.bincount(owner, (kind > 0).astype(float), n_texts))
    return out


# --------------------------------------------------------------------------- learning
def _letters(words: list[str]) -> list[str]:
    """The first run of letters of each word, in lower case."""
    return [m[0] if (m := _LETTERS.search(w.lower())) else "" for w in words]


def _pattern_counts(labelled: DataFrame) -> DataFrame:
    """``(pattern, toxic, clean)``: in how many texts a word (``=word``) or beginning occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split_words(batch.column(1))
            toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            letters = _letters(words.distinct.to_pylist())
            text = np.repeat(np.arange(batch.num_rows), np.diff(words.bounds))
            for size in (0, *BEGINNINGS):
                names: dict[str, int] = {}
                code = np.array(
                    [
                        (names.setdefault(w[:size] if size else f"={w}", len(names)) if w and len(w) > size else -1)
                        for w in letters
                    ],
                    np.int64,
                )
                pairs = np.unique((text * (len(names) + 1) + code[words.codes])[code[words.codes] >= 0])
                of, at = pairs % (len(names) + 1), pairs // (len(names) + 1)
                bad = np.bincount(of[toxic[at]], minlength=len(names))
                good = np.bincount(of[~toxic[at]], minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(names), pa.string()), pa.array(bad), pa.array(good)], ["pattern", "toxic", "clean"]
                )

    counted = labelled.select("toxic", "text").mapInArrow(run, "pattern string, toxic bigint, clean bigint")
    return counted.groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_insults(labelled: DataFrame, limit: int = 2000, least_gain: float = 30.0, least_weight: float = 1.0) -> dict[str, float]:
    """Patterns that tell toxic texts from others, with their log odds; at most ``limit`` of them."""
    totals = labelled.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).first()
    if not totals["toxic"] or not totals["clean"]:
        return {}
    p, n = float(totals["toxic"]), float(totals["clean"])
    a, b = F.col("toxic"), F.col("clean")

    def share(x, of):  # one cell of the likelihood ratio
        return F.when(x > 0, x * F.log(x / of)).otherwise(0.0)

    expected = (a + b) / (p + n)
    gain = 2 * (
        share(a, expected * p) + share(b, expected * n) + share(p - a, (1 - expected) * p) + share(n - b, (1 - expected) * n)
    )
    weight = F.log(((a + 0.5) / (p + 1)) / ((b + 0.5) / (n + 1)))
    best = (
        _pattern_counts(labelled)
        .where((a >= 5) & (a + b < p + n))
        .select("pattern", weight.alias("weight"), gain.alias("gain"))
        .where((F.col("gain") >= least_gain) & (F.col("weight") >= least_weight))
        .orderBy(F.desc("gain"), "pattern")
        .limit(limit)
    )
    return {r["pattern"]: r["weight"] for r in best.collect()}


class Lexicon:
    """Class, weight and closing punctuation of words."""

    def __init__(self, insults: dict[str, float]):
        self.insults = insults
        self.fixed = {w: c for c, ws in WORDS.items() for w in ws.split()}
        self._sizes = sorted({len(p) for p in insults if p[0] != "="}, reverse=True)
        self.cache = WordCache(self._look_up, 100_000)

    def _look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(words), 3), np.int64)
        for i, (word, letters) in enumerate(zip(words, _letters(words))):
            weight = self.insults.get("=" + letters, 0.0)
            for size in self._sizes:
                if len(letters) > size and (w := self.insults.get(letters[:size], 0.0)) > weight:
                    weight = w
            if weight:
                out[i, :2] = INSULT, int(1000 * weight)
            elif letters in self.fixed:
                out[i, :2] = self.fixed[letters], 1000
            out[i, 2] = word[-1] in ".!?;:" or word[-2:-1] in (".", "!", "?")
        return out.ravel(), np.full(len(words), 3)

    def features(self, texts: pa.Array) -> np.ndarray:
        words = split_words(texts)
        flat, begin, _ = self.cache.get(words.distinct.to_pylist())
        at = begin[words.codes]
        return clause_features(words, flat[at], flat[at + 1] / 1000.0, flat[at + 2].astype(bool))


_LEXICONS: dict[int, Lexicon] = {}


def _lexicon(insults: dict[str, float]) -> Lexicon:
    key = hash(tuple(sorted(insults.items())))
    if key not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[key] = Lexicon(insults)
    return _LEXICONS[key]


@dataclass
class Model:
    insults: dict[str, float]
    weights: np.ndarray  # of the features, and the constant


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Penalised logistic regression by Newton steps; the constant comes last and is free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), gradient)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _remainder(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    fit_rows: int = 20_000,
) -> Model:
    ids = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (_remainder(id_col) != 0))
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(fit_rows)
    )
    # At most fit_rows rows of two numbers: the broadcast has a bound.
    labelled = docs.select(
        F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).join(F.broadcast(ids), "label_id")
    own = F.crc32(F.concat(F.lit("part"), F.col("label_id").cast("string")).cast("binary")) % 4
    insults = learn_insults(labelled.where(own != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = _lexicon(insults).features(batch.column(1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), _FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["toxic", "x"])

    rows = labelled.where(own == 0).select("toxic", "text").mapInArrow(run, "toxic int, x array<double>").collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return Model(insults, np.append(np.zeros(_FEATURES), -50.0))
    return Model(insults, fit_logistic(np.array([r["x"] for r in rows]), y))


def probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    """That each text is toxic; large strings without nulls."""
    x = _lexicon(model.insults).features(texts)
    return 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -50, 50)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, score, predicted)``, one row per document."""
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        (_remainder(id_col) == 0).alias("held_out"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            p = probabilities(model, batch.column(1))
            out = [batch.column(0), batch.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, ["id", "held_out", "score", "predicted"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double, predicted int"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents predicted to be clean, with all their columns. Only the texts go to Python, one number comes back."""
    model = fit(docs, labels, id_col, text_col)

    def clean(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [probabilities(model, part.column(0)) < 0.5 for part in slices(iter([batch]), "text")]
        return pa.array(np.concatenate([np.zeros(0, bool), *parts]))

    return docs.where(F.arrow_udf(clean, "boolean")(F.col(f"`{text_col}`").cast("string")))
