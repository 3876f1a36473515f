"""BPE encoding and decoding by speculating and verifying.

Merging a word pair by pair is slow and serial. Instead, for the distinct words
of a batch: (1) greedy longest match proposes tokens; (2) one vectorised check
tests every two adjacent tokens of all words at once: a sequence of tokens is
the one that BPE gives exactly if each adjacent pair is what BPE gives for the
two tokens' own text; (3) only the words with a failing pair are merged exactly.

The pair test undoes merges at the boundary, latest first: token ids grow with
the rank of their merge, so the larger id of the two was merged last. If, at any
point, the two symbols that then touch have a merge of an earlier rank, BPE
would have merged across the boundary.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.llm.tokens import byte_of_char

#: Fixed: the word pattern of the lower-casing word vocabulary (white space is dropped).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
#: Distinct chunks that a worker keeps in its younger half; the older half is as large.
KEPT_CHUNKS = 200_000
#: Characters, and bytes of ids, that a worker handles at once; symbols up to which words are merged side by side.
SLICE, SLICE_IDS, SHORT = 1 << 20, 4 << 20, 40
NONE = np.int64(1) << 40
#: Symbols of a word in the token tree: bytes, and the word's end.
END, FANOUT = 256, 512


class Bpe:
    """The word-level BPE of a ``tokenizers`` file whose merges have growing ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = {t: i for t, i in model["vocab"].items() if t not in self.special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.first = len(self.vocab) - len(merges)
        if any(self.vocab[a + b] != self.first + i for i, (a, b) in enumerate(merges)):
            raise ValueError("token ids must follow the order of the merges")
        parts = np.array([(self.vocab[a], self.vocab[b]) for a, b in merges], np.int64).reshape(-1, 2)
        base = np.arange(self.first)
        self.left, self.right = np.concatenate([base, parts[:, 0]]), np.concatenate([base, parts[:, 1]])
        self.merge = {(a, b): self.first + i for i, (a, b) in enumerate(parts.tolist())}
        key = parts[:, 0] << 32 | parts[:, 1]
        order = np.argsort(key)
        self.pair_key, self.pair_id = key[order], order + self.first
        self.texts = token_texts(path)
        self.char_of = {b: c for c, b in byte_of_char().items()}
        byte = byte_of_char()
        size = max(map(ord, byte)) + 1
        self.byte, self.plain, self.final = (np.full(size, -1, np.int64) for _ in range(3))
        for c, b in byte.items():
            self.byte[ord(c)] = b
            self.plain[ord(c)] = self.vocab.get(c, -1)
            self.final[ord(c)] = self.vocab.get(c + self.end, -1)
        # a token that merging its own symbols does not give must not be proposed
        merged = [t for t, i in self.vocab.items() if i >= self.first]
        flat = [self.symbols(t) for t in merged]
        got, n = self.exact_many(np.array([i for f in flat for i in f], np.int64), np.array([len(f) for f in flat], np.int64))
        firsts = got[np.cumsum(n) - n]
        usable = {t: i for t, i in self.vocab.items() if i < self.first}
        usable.update((t, self.vocab[t]) for t, k, i in zip(merged, n, firsts, strict=True) if k == 1 and i == self.vocab[t])
        self._grow(usable)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _grow(self, tokens: dict[str, int]) -> None:
        """The tokens' tree: sorted keys of ``node and symbol`` with the node below, and the id that ends at a node."""
        below: dict[int, int] = {}
        ends: dict[int, int] = {}
        byte = byte_of_char()
        for t, i in tokens.items():
            final = self.end and t.endswith(self.end)
            node = 0
            for symbol in [*(byte[c] for c in (t[:-len(self.end)] if final else t)), *([END] if final else [])]:
                node = below.setdefault(node * FANOUT + symbol, len(below) + 1)
            ends[node] = i
        self.edge = np.array(sorted(below), np.int64)
        self.node = np.array([below[k] for k in self.edge.tolist()], np.int64)
        self.ends = np.full(len(below) + 1, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())

    def symbols(self, token: str) -> list[int]:
        body, end = (token[:-len(self.end)], self.end) if self.end and token.endswith(self.end) else (token, "")
        return [self.vocab[c + (end if k == len(body) - 1 else "")] for k, c in enumerate(body)]

    def exact(self, ids: list[int]) -> list[int]:
        """Merge the lowest rank first, the leftmost among equals, until none is left."""
        n = len(ids)
        ids, before, after = list(ids), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(self.merge[p], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merge]
        heapq.heapify(heap)
        while heap:
            new, k = heapq.heappop(heap)
            r = after[k]
            if ids[k] < 0 or r >= n or self.merge.get((ids[k], ids[r])) != new:
                continue  # one of the two is gone or has changed
            ids[k], ids[r], after[k] = new, -1, after[r]
            if after[k] < n:
                before[after[k]] = k
                if (found := self.merge.get((new, ids[after[k]]))) is not None:
                    heapq.heappush(heap, (found, k))
            if before[k] >= 0 and (found := self.merge.get((ids[before[k]], new))) is not None:
                heapq.heappush(heap, (found, before[k]))
        return [i for i in ids if i >= 0]

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each two merge into, or ``NONE``."""
        if not len(self.pair_key):
            return np.full(left.shape, NONE)
        key = left << 32 | right
        near = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[near] == key, self.pair_id[near], NONE)

    def exact_many(self, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``exact`` of words laid end to end: words of as many symbols make one
        step together, each its own lowest merge."""
        start = np.cumsum(size) - size
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for length in np.unique(size).tolist():
            word = np.flatnonzero(size == length)
            if length > SHORT:
                done += [(np.array([k]), np.array([self.exact(flat[start[k]:start[k] + length].tolist())])) for k in word.tolist()]
                continue
            ids = flat[start[word][:, None] + np.arange(length)]
            merge = self.pair(ids[:, :-1], ids[:, 1:])
            while merge.shape[1]:
                rows = np.arange(len(word))
                at = merge.argmin(1)  # the leftmost among equals
                new = merge[rows, at]
                over = new == NONE
                if over.any():
                    done.append((word[over], ids[over]))
                    word, ids, merge, at, new = word[~over], ids[~over], merge[~over], at[~over], new[~over]
                    rows = rows[:len(word)]
                if not len(word):
                    break
                place = np.arange(ids.shape[1] - 1)
                ids = np.take_along_axis(ids, place + (place > at[:, None]), 1)
                ids[rows, at] = new
                place = place[:-1]
                merge = np.take_along_axis(merge, place + (place >= at[:, None]), 1)
                k = np.flatnonzero(at > 0)
                merge[k, at[k] - 1] = self.pair(ids[k, at[k] - 1], ids[k, at[k]])
                k = np.flatnonzero(at < merge.shape[1])
                merge[k, at[k]] = self.pair(ids[k, at[k]], ids[k, at[k] + 1])
            if len(word):
                done.append((word, ids))
        n = np.zeros(len(size), np.int64)
        for word, ids in done:
            n[word] = ids.shape[1]
        out, begin = np.empty(int(n.sum()), np.int64), np.cumsum(n) - n
        for word, ids in done:
            out[begin[word][:, None] + np.arange(ids.shape[1])] = ids
        return out, n

    def propose_many(self, symbols: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``word, id`` in order: the longest token at each place of each word, all
        words going down the tree together. ``symbols``: the words' bytes, each word
        with its end; ``start``: where words start."""
        words, found = [], []
        word, at = np.arange(len(start)), start.copy()
        symbols = np.append(symbols, FANOUT - 1)
        while len(word):
            node, here = np.zeros(len(word), np.int64), at.copy()
            best, stop = np.full(len(word), -1, np.int64), at + 1
            live = np.arange(len(word))
            while len(live):
                symbol = symbols[here[live]]
                key = node[live] * FANOUT + symbol
                k = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
                there = self.edge[k] == key
                live, k, symbol = live[there], k[there], symbol[there]
                node[live] = self.node[k]
                here[live] += 1
                i = self.ends[node[live]]
                # with word ends in tokens, the last symbol of a word belongs to a token that ends it
                fits = i >= 0 if not self.end else (i >= 0) & ((symbol == END) | (symbols[here[live]] != END))
                best[live[fits]], stop[live[fits]] = i[fits], here[live[fits]]
            words.append(word)
            found.append(best)
            on = symbols[stop] != END if not self.end else symbols[stop - 1] != END
            word, at = word[on], stop[on]
        word, ids = np.concatenate([np.zeros(0, np.int64), *words]), np.concatenate([np.zeros(0, np.int64), *found])
        order = np.argsort(word, kind="stable")
        return word[order], ids[order]

    def tree_symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``chars, size, symbols``: the words' characters end to end, their lengths, and their way in the tree."""
        size = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        return chars, size, np.insert(self.byte[chars], np.cumsum(size), END)

    def propose(self, word: str) -> list[int]:
        return self.propose_many(self.tree_symbols([word])[2], np.zeros(1, np.int64))[1].tolist()

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE leaves each two tokens apart."""
        ok = np.ones(len(left), bool)
        at, limit = np.arange(len(left)), np.full(len(left), NONE)
        while len(at):
            merged = self.pair(left, right)
            ok[at[merged < limit]] = False
            go = (merged >= limit) & (np.maximum(left, right) >= self.first)
            at, left, right = at[go], left[go], right[go]
            undo_left = left > right
            limit = np.where(undo_left, left, right + 1)
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_left, right, self.left[right])
        return ok

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of distinct words (in byte characters)."""
        return [np.frombuffer(x, "<u4").tolist() for x in self.word_ids(words)]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words (in byte characters), little-endian 32-bit."""
        if not words:
            return []
        chars, size, symbols = self.tree_symbols(words)
        start = np.cumsum(size) - size
        owner, ids = self.propose_many(symbols, start + np.arange(len(words)))
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        apart = self.compatible(ids[inside], ids[inside + 1])
        bad = np.union1d(owner[inside[~apart]], owner[ids < 0])
        n = np.bincount(owner, minlength=len(words))
        if len(bad):
            of = np.concatenate([self.plain[chars], np.zeros(1, np.int64)])
            of[start + size - 1] = self.final[chars[start + size - 1]]
            long = size[bad]
            take = np.repeat(start[bad] - (np.cumsum(long) - long), long) + np.arange(int(long.sum()))
            new, m = self.exact_many(of[take], long)
            keep = ~np.isin(owner, bad)
            order = np.argsort(np.concatenate([owner[keep], np.repeat(bad, m)]), kind="stable")
            ids = np.concatenate([ids[keep], new])[order]
            n[bad] = m
        data, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(n)).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def pieces(self, chunk: str) -> list:
        """A chunk without white space as words in byte characters; ids for special tokens."""
        out, at = [], 0
        if self.cut is not None and "<" in chunk:
            for m in self.cut.finditer(chunk):
                out += [*self._plain(chunk[at:m.start()]), self.special[m[0]]]
                at = m.end()
        return out + self._plain(chunk[at:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii() and text.isalpha():
            return [text.lower()]
        # each character is lower-cased alone, so a final sigma is an ordinary one
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # printable ASCII characters stand for their own bytes
        return [w if w.isascii() and w.isprintable() else "".join(map(self.char_of.__getitem__, w.encode()))
                for w in _pattern().findall(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian 32-bit."""
        parts = [_spaces().split(t) if _controls().search(t) else t.split() for t in texts]
        young, old = self.young, self.old
        new = []
        for c in {c for p in parts for c in p}.difference(young):
            if (known := old.get(c)) is None:
                new.append(c)
            else:
                young[c] = known
        cut = [self.pieces(c) for c in new]
        unknown = list({w for p in cut for w in p if isinstance(w, str)})
        words = dict(zip(unknown, self.word_ids(unknown), strict=True))
        for c, p in zip(new, cut, strict=True):
            young[c] = words[p[0]] if len(p) == 1 and isinstance(p[0], str) else b"".join(
                [words[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in p])
        out = [b"".join(map(young.__getitem__, p)) for p in parts]
        if len(young) > KEPT_CHUNKS:  # the younger half grows old, the older one goes
            self.young, self.old = {}, young
        return out

    def decode(self, ids: bytes) -> str:
        return decode(self.texts, ids)


def decode(texts: list[str], ids: bytes) -> str:
    """The tokens joined by a space: the vocabulary has no decoder of its own."""
    return " ".join(map(texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def token_texts(path: str) -> list[str]:
    """The text of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [""] * (max(ids.values(), default=-1) + 1)
    for t, i in ids.items():
        out[i] = t
    return out


def slices(values: list, limit: int):
    """Ranges of values of about ``limit`` characters or bytes together."""
    start = held = 0
    for k, v in enumerate(values, 1):
        held += len(v or b"")
        if held >= limit or k == len(values):
            yield start, k
            start, held = k, 0


@cache
def _pattern():
    return regex.compile(WORD)


@cache
def _spaces():
    return regex.compile(r"\p{White_Space}+")


@cache
def _controls():
    return regex.compile(r"[\x1c-\x1f]")  # str.split takes them for white space


@cache
def bpe(path: str) -> Bpe:
    """One encoder a worker process."""
    return Bpe(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids`` (little-endian 32-bit).

    A null text is an empty one and has no ids. Repeated rows give equal rows,
    an empty table none; other columns are not read. Special tokens that a text
    spells out become their ids."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for start, stop in slices(texts, SLICE):
                ids = bpe(path).encode(texts[start:stop])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(start, stop - start), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the text of their ids (null: empty)."""
    names = [*encoded.columns, "decoded"]

    def run(batches):
        for b in batches:
            ids = b.column(ids_col).to_pylist()
            for start, stop in slices(ids, SLICE_IDS):
                texts = [decode(token_texts(path), x or b"") for x in ids[start:stop]]
                yield pa.RecordBatch.from_arrays([*(c.slice(start, stop - start) for c in b.columns), pa.array(texts, pa.string())],
                                                 names=names)

    return encoded.mapInArrow(run, encoded.select("*", F.lit("").alias("decoded")).schema)
