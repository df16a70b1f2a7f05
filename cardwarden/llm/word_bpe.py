"""Prefix dynamic programming for a word-level byte BPE.

The encoding of a word is unique, so the encoding of every prefix ends in one certain token. Let
``last[i]`` be that token for the first ``i`` symbols and ``count[i]`` the number of tokens. Then
``last[i]`` is the only vocabulary entry ``t`` covering the last ``len(t)`` symbols that may stand
behind ``last[i - len(t)]``, and ``count[i] = count[i - len(t)] + 1``. Two tokens may stand side by
side when undoing their merges, latest first, never uncovers a merge across the border that would have
come earlier. Words of one length are handled together in numpy.

Symbols are bytes; the last symbol of a finished word carries the end mark (byte + 256).
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from cardwarden.llm.words import spread

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xC2B2AE3D27D4EB4F | 1
_MASK = (1 << 64) - 1
#: Words longer than this are handled one at a time.
LONG_WORD = 96
#: Positions of such a word that are looked up together.
LONG_BLOCK = 65_536
#: The pre-tokenizer's pattern (fixed value of the vocabulary file), and the separator used here.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")


class IntTable:
    """64-bit keys to int32 values; vectorised open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, spread: int = 8):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * spread))))
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._keys = np.zeros(1 << bits, np.uint64)
        self._values = np.full(1 << bits, -1, np.int32)
        self._probes = 1
        todo_keys, todo_values = keys.astype(np.uint64), values.astype(np.int32)
        slots = self._slot(todo_keys)
        while len(todo_keys):
            free = self._values[slots] < 0
            first = np.zeros(len(slots), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            # A free slot wanted twice goes to one key; the others look at the next slot.
            self._keys[slots[put]] = todo_keys[put]
            self._values[slots[put]] = todo_values[put]
            todo_keys, todo_values = todo_keys[~put], todo_values[~put]
            slots = (slots[~put] + 1) & self._mask
            self._probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slots = self._slot(keys)
        values = self._values[slots]
        found = np.where(self._keys[slots] == keys, values, -1)
        open_ = np.flatnonzero((found < 0) & (values >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self._mask
            at = slots[open_]
            values = self._values[at]
            hit = (self._keys[at] == keys[open_]) & (values >= 0)
            found[open_[hit]] = values[hit]
            open_ = open_[~hit & (values >= 0)]
        return found


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1 characters stand
    for themselves, all others follow from U+0100 on in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordBpe:
    """Exact ids and prefix counts of distinct words, as the ``tokenizers`` library would give them.

    ``content``: a ``tokenizer.json`` whose model is a BPE with end-of-word mark ``</w>``, NFC + lower
    case + white space removed. Words holding special strings, or characters that the installed Unicode
    tables don't know, are given to the library itself.
    """

    def __init__(self, content: str):
        self._content = content
        self._library: Tokenizer | None = None
        spec = json.loads(content)
        model = spec["model"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        symbol = byte_symbols()

        def symbols(token: str) -> tuple[int, ...]:
            ended = token.endswith("</w>") and len(token) > 4
            out = [symbol[c] for c in (token[:-4] if ended else token)]
            if ended:
                out[-1] += 256
            return tuple(out)

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        vocab = model["vocab"]
        index = {}
        ids = np.zeros(512 + len(merges), np.int64)
        contents: list[tuple[int, ...]] = [(s,) for s in range(512)]
        for token, i in vocab.items():
            if len(parts := symbols(token)) == 1:
                index[token] = parts[0]
                ids[parts[0]] = i
        left, right = np.zeros(512 + len(merges), np.int64), np.zeros(512 + len(merges), np.int64)
        for at, (a, b) in enumerate(merges, 512):
            if a + b in index:
                raise ValueError("two merges make the same token")
            index[a + b] = at
            ids[at] = vocab[a + b]
            left[at], right[at] = index[a], index[b]
            contents.append(contents[index[a]] + contents[index[b]])
        self.ids, self._left, self._right = ids, left, right
        self._lengths = np.array([len(c) for c in contents], np.int64)
        self._longest = int(self._lengths.max())
        made = np.arange(512, 512 + len(merges))
        self._merge = IntTable((left[512:] << 20 | right[512:]).astype(np.uint64), made)
        self._power = [pow(_BASE, n, 1 << 64) for n in range(self._longest + 1)]
        hashes = np.array([self._hash(c) for c in contents], np.uint64)
        self._token = IntTable(self._keyed(hashes, self._lengths), np.arange(len(contents)))
        order = np.argsort(-np.bincount(self._lengths, minlength=self._longest + 1), kind="stable")
        self._by_use = [int(n) for n in order if n > 0]
        self._plain: tuple[dict[int, int], list[int], list[int], list[int]] | None = None  # for long words
        # Answers to "may r stand behind l?"; a slot keeps the latest pair.
        self._known_pair = np.full(1 << 20, -1, np.int64)
        self._known_answer = np.zeros(1 << 20, bool)

    @staticmethod
    def _hash(symbols) -> int:
        h = 0
        for s in symbols:
            h = (h * _BASE + int(s) + 1) & _MASK
        return h

    @staticmethod
    def _keyed(hashes: np.ndarray, lengths) -> np.ndarray:
        return hashes ^ (np.uint64(0xD6E8FEB86659FD93) * np.asarray(lengths, np.uint64))

    # ------------------------------------------------------------------ borders
    def _border_holds(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the border between two tokens survives all merges."""
        holds = np.ones(len(left), bool)
        at = np.arange(len(left))
        limit = np.full(len(left), len(self.ids), np.int64)
        l, r = left.astype(np.int64), right.astype(np.int64)
        while len(at):
            merged = self._merge.get((l << 20 | r).astype(np.uint64))
            broken = (merged >= 0) & (merged < limit)
            holds[at[broken]] = False
            go = ~broken & (np.maximum(l, r) >= 512)
            at, l, r = at[go], l[go], r[go]
            undo_left = l > r
            limit = np.where(undo_left, l, r + 1)
            l, r = np.where(undo_left, self._right[l], l), np.where(undo_left, r, self._left[r])
        return holds

    def _may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 20 | right
        slot = ((pair.astype(np.uint64) * _MULTIPLIER) >> np.uint64(44)).astype(np.int64)
        answer = self._known_answer[slot]
        new = np.flatnonzero(self._known_pair[slot] != pair)
        if len(new):
            distinct, back = np.unique(pair[new], return_inverse=True)
            holds = self._border_holds(distinct >> 20, distinct & 0xFFFFF)
            answer[new] = holds[back]
            at = ((distinct.astype(np.uint64) * _MULTIPLIER) >> np.uint64(44)).astype(np.int64)
            at, first = np.unique(at, return_index=True)
            self._known_pair[at], self._known_answer[at] = distinct[first], holds[first]
        return answer

    # ------------------------------------------------------------------ words of one length
    def _last_tokens(self, symbols: np.ndarray, every_end: bool) -> tuple[np.ndarray, np.ndarray]:
        """``symbols``: (words, n) bytes. Last tokens of the unfinished prefixes (words, n + 1) and of the
        prefixes taken as whole words; of the latter only column n unless ``every_end``."""
        words, n = symbols.shape
        inner = np.full((words, n + 1), -1, np.int32)
        ended = np.full((words, n + 1), -1, np.int32)
        values = symbols.astype(np.uint64) + np.uint64(1)
        hashes = np.zeros((n + 1, words), np.uint64)
        for i in range(n):
            hashes[i + 1] = hashes[i] * np.uint64(_BASE) + values[:, i]
        for i in range(1, n + 1):
            targets = ([(inner, 0)] if i < n else []) + ([(ended, 256)] if every_end or i == n else [])
            for table, mark in targets:
                todo = np.arange(words)
                for size in self._by_use:
                    if size > i:
                        continue
                    full = hashes[i][todo] - hashes[i - size][todo] * np.uint64(self._power[size])
                    token = self._token.get(self._keyed(full + np.uint64(mark), size))
                    hit = np.flatnonzero(token >= 0)
                    if len(hit) and i > size:
                        rows = todo[hit]
                        hit = hit[self._may_follow(inner[rows, i - size], token[hit])]
                    if len(hit):
                        table[todo[hit], i] = token[hit]
                        keep = np.ones(len(todo), bool)
                        keep[hit] = False
                        todo = todo[keep]
                        if not len(todo):
                            break
                if len(todo):
                    raise AssertionError("a prefix without an encoding")
        return inner, ended

    def _one_length(self, symbols: np.ndarray, prefixes: bool):
        words, n = symbols.shape
        inner, ended = self._last_tokens(symbols, prefixes)
        rows = np.arange(words)
        if prefixes:
            count = np.zeros((words, n + 1), np.int32)
            out = np.zeros((words, n), np.int32)
            for i in range(1, n + 1):
                if i < n:
                    count[:, i] = count[rows, i - self._lengths[inner[:, i]]] + 1
                out[:, i - 1] = count[rows, i - self._lengths[ended[:, i]]] + 1
            return out.ravel(), np.full(words, n, np.int64)
        back = np.full((words, n), -1, np.int64)
        at, token, step = np.full(words, n), ended[:, n].astype(np.int64), 0
        todo = rows
        while len(todo):
            back[todo, n - 1 - step] = self.ids[token]
            at = at - self._lengths[token]
            go = at > 0
            todo, at = todo[go], at[go]
            token, step = inner[todo, at].astype(np.int64), step + 1
        kept = back >= 0
        return back[kept], kept.sum(1)

    def _ending_tokens(self, hashes: np.ndarray, begin: int, end: int, mark: int) -> tuple[list[int], list[int]]:
        """Tokens that end at the positions ``begin + 1`` to ``end`` of a word, longest first, flat, and where
        each position's tokens begin there; one pass for each token length over all positions."""
        places, tokens = [], []
        for size in range(min(end, self._longest), 0, -1):
            i = np.arange(max(begin + 1, size), end + 1)
            full = hashes[i] - hashes[i - size] * np.uint64(self._power[size])
            token = self._token.get(self._keyed(full + np.uint64(mark), size))
            hit = np.flatnonzero(token >= 0)
            places.append(i[hit])
            tokens.append(token[hit])
        place = np.concatenate(places)
        order = np.argsort(place, kind="stable")
        bounds = np.concatenate([[0], np.cumsum(np.bincount(place - begin - 1, minlength=end - begin))])
        return np.concatenate(tokens)[order].tolist(), bounds.tolist()

    def _long_word(self, word: bytes, prefixes: bool):
        """The same recurrence for one long word: tokens are looked up for a block of positions at a time, then
        chained position by position on plain numbers."""
        n = len(word)
        if self._plain is None:
            made = range(512, len(self.ids))
            left, right, length = self._left.tolist(), self._right.tolist(), self._lengths.tolist()
            self._plain = {left[t] << 20 | right[t]: t for t in made}, left, right, length
        merges, lefts, rights, lengths = self._plain
        merged, top = merges.get, len(self.ids)

        def holds(l: int, r: int) -> bool:
            limit = top
            while True:
                if merged(l << 20 | r, limit) < limit:
                    return False
                if l < 512 and r < 512:
                    return True
                if l > r:
                    limit, l = l, rights[l]
                else:
                    limit, r = r + 1, lefts[r]

        # Powers and their inverses modulo 2^64 make the running hashes one wrapping sum.
        inverse = pow(_BASE, -1, 1 << 64)
        power, back = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, inverse, np.uint64)
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        values = np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1)
        hashes = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * back[1:], dtype=np.uint64) * power[1:]])
        del power, back, values

        inner, count = [-1] * (n + 1), [0] * (n + 1)
        ends = np.zeros(n, np.int32)

        def last(i: int, tokens: list[int]) -> int:
            for t in tokens:
                before = inner[i - lengths[t]]
                if before < 0 or holds(before, t):
                    return t
            raise AssertionError("a prefix without an encoding")

        for begin in range(0, n, LONG_BLOCK):
            end = min(n, begin + LONG_BLOCK)
            tokens, bounds = self._ending_tokens(hashes, begin, end, 0)
            whole, whole_bounds = self._ending_tokens(hashes, begin, end, 256) if prefixes or end == n else ([], None)
            for i in range(begin + 1, end + 1):
                k = i - begin
                if prefixes or i == n:
                    final = last(i, whole[whole_bounds[k - 1] : whole_bounds[k]])
                    ends[i - 1] = count[i - lengths[final]] + 1
                if i < n:
                    t = last(i, tokens[bounds[k - 1] : bounds[k]])
                    inner[i], count[i] = t, count[i - lengths[t]] + 1
        if prefixes:
            return ends
        out, at, t = [], n, final
        while True:
            out.append(int(self.ids[t]))
            at -= lengths[t]
            if at == 0:
                return np.array(out[::-1], np.int64)
            t = inner[at]

    def _pieces(self, words: list[bytes], prefixes: bool) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids (or counts at every byte prefix) and how many of them each word has."""
        lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        sizes = np.zeros(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            if n > LONG_WORD:
                for w in which:
                    out = self._long_word(words[w], prefixes)
                    parts.append((np.array([w]), out, np.array([len(out)])))
                continue
            for some in np.array_split(which, -(-len(which) // 20_000)):
                symbols = flat[starts[some][:, None] + np.arange(n)]
                parts.append((some, *self._one_length(symbols, prefixes)))
        for some, _, size in parts:
            sizes[some] = size
        begin = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(begin[-1], np.int64)
        for some, values, size in parts:
            out[spread(begin[some], size)] = values
        return out, sizes

    # ------------------------------------------------------------------ chunks between white space
    def library(self) -> Tokenizer:
        if self._library is None:
            self._library = Tokenizer.from_str(self._content)
        return self._library

    def _split(self, chunks: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pieces, the pieces of all chunks as indices to them, the number of pieces of each chunk,
        and which chunks only the library can handle (they get no pieces here)."""
        joined = "\n".join(chunks)
        odd = np.zeros(len(chunks), bool)
        unknown = {x for x in set(joined) if unicodedata.category(x) in ("Cn", "Cs")}
        marks = [s for s in self.special if s in joined]
        if unknown or marks:
            for i, c in enumerate(chunks):
                odd[i] = not unknown.isdisjoint(c) or any(s in c for s in marks)
            joined = "\n".join("" if o else c for o, c in zip(odd, chunks))
        joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ").lower()
        coded = pa.array([*_PIECES.findall(joined), "\n"], pa.string()).dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        ends = np.flatnonzero(index == pc.index(coded.dictionary, "\n").as_py())
        return coded.dictionary, np.delete(index, ends), np.diff(ends, prepend=-1) - 1, odd

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of chunks without ASCII white space, and the number of ids of each."""
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pieces, order, per_chunk, odd = self._split(chunks)
        ids, sizes = self._pieces([p.encode() for p in pieces.to_pylist()], False)
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        flat = ids[spread(begin[order], sizes[order])]
        ends = np.concatenate([[0], np.cumsum(sizes[order])])
        bounds = np.concatenate([[0], np.cumsum(per_chunk)])
        counts = ends[bounds[1:]] - ends[bounds[:-1]]
        if odd.any():
            parts, at = [], np.concatenate([[0], np.cumsum(counts)])
            previous = 0
            for i in np.flatnonzero(odd):
                own = self.library().encode(chunks[i], add_special_tokens=False).ids
                parts += [flat[previous : at[i]], np.array(own, np.int64)]
                previous, counts[i] = at[i], len(own)
            flat = np.concatenate([*parts, flat[previous:]])
        return flat, counts

    def prefix_counts(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each chunk the token count of each of its character prefixes, flat, and the chunk lengths."""
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(begin[-1], np.int64)
        # Where every character keeps its place and no contraction can start, prefixes of pieces suffice.
        moving = {x for x in set("".join(chunks)) if not _stable(x)}
        simple = np.fromiter((moving.isdisjoint(c) for c in chunks), bool, len(chunks)) if moving else np.ones(len(chunks), bool)
        which = np.flatnonzero(simple)
        plain = [chunks[i] for i in which] if moving else chunks
        if plain:
            pieces, order, per_chunk, odd = self._split(plain)
            words = pieces.to_pylist()
            by_byte, _ = self._pieces([w.encode() for w in words], True)
            n_chars = np.fromiter(map(len, words), np.int64, len(words))
            raw = np.frombuffer("".join(words).encode(), np.uint8)
            # A character prefix ends where the next character's first byte stands.
            by_char = by_byte[np.flatnonzero(np.append((raw[1:] & 0xC0) != 0x80, True))]
            word_at = np.concatenate([[0], np.cumsum(n_chars)])
            per_piece = n_chars[order]
            values = by_char[spread(word_at[order], per_piece)]
            whole = by_char[word_at[order + 1] - 1]
            # Add what the earlier pieces of the same chunk have.
            before = np.cumsum(whole) - whole
            first = np.concatenate([[0], np.cumsum(per_chunk)])[:-1]
            some = per_chunk > 0
            before -= np.repeat(before[first[some]], per_chunk[some])
            simple[which[odd]] = False
            there = which[~odd]
            out[spread(begin[there], sizes[there])] = values + np.repeat(before, per_piece)
        for i in np.flatnonzero(~simple):
            out[begin[i] : begin[i + 1]] = self._odd_prefixes(chunks[i])
        return out, sizes

    def _odd_prefixes(self, chunk: str) -> list[int]:
        """Contractions, composed letters, letters that change length, special strings: prefix by prefix."""
        counts: list[int] = []
        # In portions, so that a long chunk does not hold all its prefixes' ids at a time.
        step = max(1, 200_000 // max(1, len(chunk)))
        for at in range(0, len(chunk), step):
            some = [chunk[: i + 1] for i in range(at, min(at + step, len(chunk)))]
            counts += [int(n) for n in self.encode(some)[1]]
        return counts


@functools.cache
def _stable(char: str) -> bool:
    """Whether the character stays one character in its place, whatever stands beside it."""
    return (
        char.isascii() and char not in "'<\x1c\x1d\x1e\x1f"
        or char.isalnum()
        and len(unicodedata.normalize("NFC", char).lower()) == 1
        and not "\u1100" <= char <= "\u11ff"
        and not "\uac00" <= char <= "\ud7ff"
    )


_LOADED: dict[str, WordBpe] = {}


def load(content: str) -> WordBpe:
    """The encoder of a vocabulary, built once in each worker."""
    if content not in _LOADED:
        _LOADED.clear()
        _LOADED[content] = WordBpe(content)
    return _LOADED[content]
