"""BPE encoding by speculation and verification, and decoding, for a tokenizer file with word ends.

The text is cut into words as the file says. For each distinct word, greedy longest match proposes tokens. A proposal is the
result of the merges exactly if no merge would cross any boundary between two of its tokens, and whether one crosses depends on the
two tokens at the boundary alone. So all adjacent pairs of all proposals are checked together, as arrays; only words with a failing
pair go through the merges, side by side as rows of a matrix: each round does one merge of every word.

Whether a merge crosses a boundary is read from the merge ranks. Merges run by rank, so a token on the right edge of the left side
lives from its own rank to that of the token that absorbs it, and the same holds on the left edge of the right side. Both edges are
unrolled backwards in time, the later merge first; a merge of two edge tokens that comes before either is absorbed crosses.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm.base import fresh, query, table

#: Characters of text handled at once; one longer text is handled alone.
SLICE = 1_000_000
#: Characters of distinct words whose tokens a task remembers, some 30 bytes each, and words that are encoded at once.
MEMORY = 2_500_000
WORDS = 4_096
#: Symbols of a word that is merged beside others, a longer one is merged alone; and rows of a matrix of such words.
LONG = 64
ROWS = 2_048
_NEVER = np.int64(1) << 40
#: The first character that others combine with.
COMBINING = 0x300
BREAK, LETTER, DIGIT, OTHER = 0, 1, 2, 3
_UNKNOWN = 255


class Merges:
    """Vocabulary and merges of a BPE model as arrays."""

    def __init__(self, model: dict):
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        size = max(self.ids.values()) + 1
        self.tokens: list[str | None] = [None] * size
        for t, i in self.ids.items():
            self.tokens[i] = t
        merges = [m if isinstance(m, (list, tuple)) else m.split(" ", 1) for m in model["merges"]]
        left = np.array([self.ids[a] for a, _ in merges], np.int64)
        right = np.array([self.ids[b] for _, b in merges], np.int64)
        made = np.array([self.ids[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges), dtype=np.int64)
        self.pairs = {(a, b): (r, m) for a, b, r, m in zip(left.tolist(), right.tolist(), rank.tolist(), made.tolist())}
        #: of each token, the rank of its merge (-1: a symbol of the alphabet) and its parts
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.rank[made], self.left[made], self.right[made] = rank, left, right
        self.size = size
        code = left * size + right
        order = np.argsort(code)
        self.codes, self.code_ranks, self.made = code[order], rank[order], made
        #: of each letter, its symbol's id inside a word and at its end (-1: none); the last entry stands for all later letters
        top = max([ord(t[0]) for t in self.ids if t], default=0) + 1
        self.inner, self.last = np.full(top + 1, -1, np.int64), np.full(top + 1, -1, np.int64)
        for t, i in self.ids.items():
            if len(t) == 1:
                self.inner[ord(t)] = i
            if len(t) == 1 + len(self.end) and t.endswith(self.end):
                self.last[ord(t[0])] = i
        self.distinct = bool((self.codes[1:] != self.codes[:-1]).all())
        #: the check needs that every token has one merge, and that parts are made before what they make
        self.regular = bool(len(np.unique(made)) == len(made) and (np.maximum(self.rank[left], self.rank[right]) < rank).all())
        self.sound = self._sound(made, left, right)
        # proposals only use tokens that the merges give back from the token's own text
        self.known = {t: i for t, i in self.ids.items() if self.sound[i]}
        #: length of the longest token that starts with these two letters
        self.reach: dict[str, int] = {}
        for t in self.known:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        self._plant()

    def _plant(self) -> None:
        """Prefix tree of the tokens for proposals. A letter at a word's end is another symbol than the same letter inside."""
        letters = sorted({x for t in self.known for x in t})
        self.symbols_many = 2 * len(letters) + 1
        self.symbol = np.full(max(map(ord, letters), default=0) + 2, self.symbols_many - 1, np.int64)
        self.symbol[[ord(x) for x in letters]] = np.arange(len(letters))
        self.at_end = len(letters) if self.end else 0
        place, edges, of = {x: i for i, x in enumerate(letters)}, {}, {0: -1}
        for t, i in self.known.items():
            ended = self.end and t.endswith(self.end)
            path = [place[x] for x in (t[:-len(self.end)] if ended else t)]
            if not path:
                continue
            if ended:
                path[-1] += self.at_end
            node = 0
            for x in path:
                node = edges.setdefault(node * self.symbols_many + x, len(edges) + 1)
            of[node] = i
        self.edges = np.array(sorted(edges), np.int64)
        self.children = np.array([edges[e] for e in self.edges.tolist()], np.int64)
        self.of = np.full(len(edges) + 1, -1, np.int64)
        self.of[list(of)] = list(of.values())

    def _sound(self, made, left, right) -> np.ndarray:
        alone = np.ones(self.size, bool)
        alone[made] = False
        if not self.regular:
            return alone
        limit = self.rank[made]
        fits = self._apart(left, right, limit, limit)
        for m, a, b, ok in zip(made.tolist(), left.tolist(), right.tolist(), fits.tolist()):
            alone[m] = ok and alone[a] and alone[b]
        return alone

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * self.size + b
        at = np.minimum(np.searchsorted(self.codes, code), max(len(self.codes) - 1, 0))
        if not len(self.codes):
            return np.full(len(code), _NEVER)
        return np.where(self.codes[at] == code, self.code_ranks[at], _NEVER)

    def _apart(self, a, b, until_a, until_b) -> np.ndarray:
        """Whether no merge crosses the boundary of a and b, which are absorbed at the ranks ``until_a`` and ``until_b``."""
        out = np.ones(len(a), bool)
        row, a, b = np.arange(len(a)), a.copy(), b.copy()
        until_a, until_b = (np.broadcast_to(u, len(row)).astype(np.int64) for u in (until_a, until_b))
        while len(row):
            crossing = self._rank_of(a, b)
            # of two equal merges the left one comes first
            bad = (crossing < until_a) & (crossing <= until_b)
            out[row[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            row, a, b, ra, rb, until_a, until_b = (x[go] for x in (row, a, b, ra, rb, until_a, until_b))
            older = ra > rb
            # of the same merge on both sides, the right one is the later and is undone first
            a, until_a, b, until_b = (np.where(older, self.right[a], a), np.where(older, ra, until_a),
                                      np.where(older, b, self.left[b]), np.where(older, until_b, rb))
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges of the text of tokens a and b, next to each other, give these two again."""
        if not self.regular:
            return np.zeros(len(a), bool)
        return self._apart(a, b, _NEVER - 1, _NEVER - 1) & self.sound[a] & self.sound[b]

    def symbols(self, word: str) -> list[str]:
        return [*word[:-1], word[-1] + self.end]

    def greedy(self, word: str) -> list[int] | None:
        """Longest tokens from left to right; None where no token fits."""
        out, at, n, known, reach = [], 0, len(word), self.known, self.reach
        text = word + self.end
        while at < n:
            most = reach.get(text[at:at + 2], 1)
            found = known.get(text[at:]) if len(text) - at <= most else None
            stop = n
            if found is None:
                stop = min(n - 1, at + most)
                while stop > at and (found := known.get(text[at:stop])) is None:
                    stop -= 1
                if found is None:
                    return None
            out.append(found)
            at = stop
        return out

    def proposed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, how many for each word) by ``greedy``, none where no token fits; words of up to ``LONG`` letters side by side."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        letter = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), len(self.symbol) - 1)
        ends, fits = np.cumsum(n), np.ones(len(words), bool)
        symbol = self.symbol[letter]
        plain = symbol[ends - 1] < self.symbols_many - 1
        symbol[ends[plain] - 1] += self.at_end
        alone = [(i, self.greedy(words[i]) or []) for i in np.flatnonzero(n > LONG).tolist()]
        found = [(np.full(len(t), i, np.int64), np.array(t, np.int64)) for i, t in alone]
        own = np.flatnonzero(n <= LONG)
        at = (ends - n)[own]
        while len(own) and len(self.edges):
            token, stop = self._longest(symbol, at, ends[own])
            go = token >= 0
            fits[own[~go]] = False
            found.append((own[go], token[go]))
            go &= stop < ends[own]
            own, at = own[go], stop[go]
        word, token = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
        word, token = word[fits[word]], token[fits[word]]
        return token[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _longest(self, symbol: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the longest token that starts at each place, or -1; where it ends)."""
        token, stop = np.full(len(at), -1, np.int64), at.copy()
        live, node, place = np.arange(len(at)), np.zeros(len(at), np.int64), at
        while len(live):
            edge = node * self.symbols_many + symbol[place]
            child = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            go = self.edges[child] == edge
            live, node, place = live[go], self.children[child[go]], place[go] + 1
            made = self.of[node]
            whole = made >= 0
            token[live[whole]], stop[live[whole]] = made[whole], place[whole]
            go = place < ends[live]
            live, node, place = live[go], node[go], place[go]
        return token, stop

    def merged(self, word: str) -> list[int]:
        """Exact merging: always the merge of the lowest rank, the leftmost of equal ones. Symbols without an id are left out."""
        token = [self.ids[s] for s in self.symbols(word) if s in self.ids]
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.pairs[p], i) for i, p in enumerate(zip(token, token[1:])) if p in self.pairs]
        heap = [(r, i, m) for r, m, i in heap]
        heapq.heapify(heap)
        while heap:
            r, i, made = heapq.heappop(heap)
            j = after[i]
            if token[i] is None or j >= n or self.pairs.get((token[i], token[j]), (None, None))[0] != r:
                continue
            token[i], token[j] = made, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := self.pairs.get((token[x], token[y]))):
                    heapq.heappush(heap, (p[0], x, p[1]))
        return [t for t in token if t is not None]

    def merged_together(self, words: list[str]) -> list[list[int]]:
        """What ``merged`` gives for each word; words of up to ``LONG`` letters are merged side by side."""
        out: list = [None] * len(words)
        n = np.fromiter(map(len, words), np.int64, len(words))
        alone = (n > LONG) | (not self.distinct)
        for i in np.flatnonzero(alone).tolist():
            out[i] = self.merged(words[i])
        order = np.argsort(n, kind="stable")
        order = order[~alone[order]]
        for start in range(0, len(order), ROWS):
            rows = order[start:start + ROWS]
            for i, found in zip(rows.tolist(), self._merged_rows([words[i] for i in rows.tolist()], n[rows])):
                out[i] = found
        return out

    def _merged_rows(self, words: list[str], n: np.ndarray) -> list[list[int]]:
        letter = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), len(self.inner) - 1)
        ends = np.cumsum(n)
        symbol = self.inner[letter]
        symbol[ends - 1] = self.last[letter[ends - 1]]
        word = np.repeat(np.arange(len(words)), n)[symbol >= 0]
        n = np.bincount(word, minlength=len(words))
        # a column more than the longest word has, so that there is always a next one
        token = np.full((len(words), int(n.max()) + 1), -1, np.int64)
        token[word, np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)] = symbol[symbol >= 0]
        rank = np.full(token.shape, _NEVER)
        rank[:, :-1] = self._ranks(token[:, :-1], token[:, 1:])
        column, own, out = np.arange(token.shape[1]), np.arange(len(words)), token.copy()
        while len(own):
            row = np.arange(len(own))
            at = rank.argmin(axis=1)
            least = rank[row, at]
            go = least < _NEVER
            if not go.all():
                out[own[~go]] = token[~go]
                token, rank, own, at, least, row = token[go], rank[go], own[go], at[go], least[go], row[:int(go.sum())]
                if not len(own):
                    break
            token[row, at] = self.made[least]
            later = column[:-1] > at[:, None]
            for x, empty in ((token, -1), (rank, _NEVER)):
                x[:, :-1] = np.where(later, x[:, 1:], x[:, :-1])
                x[:, -1] = empty
            rank[row, at] = self._ranks(token[row, at], token[row, at + 1])
            inside = at > 0
            row, at = row[inside], at[inside]
            rank[row, at - 1] = self._ranks(token[row, at - 1], token[row, at])
        return [t[:k] for t, k in zip(out.tolist(), (out >= 0).sum(axis=1).tolist())]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, of which a token may be missing (-1)."""
        out = np.full(a.shape, _NEVER)
        there = (a >= 0) & (b >= 0)
        out[there] = self._rank_of(a[there], b[there])
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        """Tokens of words (of the model's alphabet): proposed, verified together, merged where the check fails."""
        flat, n = self.proposed(words)
        word = np.repeat(np.arange(len(words)), n)
        near = word[:-1] == word[1:]
        pair, back = np.unique(flat[:-1][near] * self.size + flat[1:][near], return_inverse=True)
        good = self.compatible(pair // self.size, pair % self.size)[back] if len(pair) else np.ones(0, bool)
        failed = np.bincount(word[:-1][near][~good], minlength=len(words)) > 0
        ids, ends = flat.tolist(), np.cumsum(n).tolist()
        out = [ids[i:j] for i, j in zip([0, *ends], ends)]
        again = np.flatnonzero(failed | (n == 0)).tolist()
        for i, found in zip(again, self.merged_together([words[i] for i in again])):
            out[i] = found
        return out


class Places(dict):
    """Places of words in the order in which they are first looked up; a number (the id of an added token) has -1 - number."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.many = 0

    def __missing__(self, word: str | int) -> int:
        if isinstance(word, int):
            place = -1 - word
        else:
            place = self.many
            self.many += 1
            self.new.append(word)
        self[word] = place
        return place


class Memory:
    """Tokens of the words that a task has met, up to ``MEMORY`` characters of words; then it starts anew."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self.encode = encode
        self._forget()

    def _forget(self) -> None:
        self.known, self.held = Places(), 0
        self.flat = np.zeros(1 << 12, np.int32)
        self.first = np.zeros(1 << 10, np.int64)

    def places(self, words: list) -> np.ndarray:
        """Places of the words in ``first``."""
        if self.held > MEMORY:
            self._forget()
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        new, self.known.new = self.known.new, []
        many = self.known.many - len(new)
        for start in range(0, len(new), WORDS):
            part = new[start:start + WORDS]
            found = self.encode(part)
            have, flat = int(self.first[many]), np.fromiter(chain.from_iterable(found), np.int32)
            while have + len(flat) > len(self.flat):
                self.flat = np.append(self.flat, np.zeros_like(self.flat))
            while many + len(part) + 1 > len(self.first):
                self.first = np.append(self.first, np.zeros_like(self.first))
            self.flat[have:have + len(flat)] = flat
            self.first[many + 1:many + len(part) + 1] = have + np.cumsum([len(t) for t in found])
            many += len(part)
            self.held += sum(map(len, part))
        return at

    def tokens(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many for each place)."""
        first = np.where(at >= 0, self.first[np.maximum(at, 0)], 0)
        n = np.where(at >= 0, self.first[np.maximum(at, 0) + 1] - first, 1)
        start = np.cumsum(n) - n
        ids = self.flat[np.arange(n.sum()) - np.repeat(start - first, n)]
        ids[start[at < 0]] = -1 - at[at < 0]
        return ids, n


class Kinds:
    """Class of each character, which ``ask`` says once for each."""

    def __init__(self, ask: Callable[[str], int]):
        self.ask = ask
        self.kind = np.full(0x110000, _UNKNOWN, np.uint8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        kind = self.kind[codes]
        if (kind == _UNKNOWN).any():
            for c in np.unique(codes[kind == _UNKNOWN]).tolist():
                self.kind[c] = self.ask(chr(c))
            kind = self.kind[codes]
        return kind


class Tokens:
    """A tokenizer file whose words are cut by letters, digits, others and English contractions, with its own normaliser."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.model = Merges(spec["model"])
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that depend on their surroundings aren't supported")
        if spec["decoder"] is not None or spec["post_processor"] is not None or not self._cuts_words(spec["pre_tokenizer"]):
            raise ValueError("this tokenizer cuts words or decodes in another way")
        by_length = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        size = max([self.model.size - 1, *self.special.values()]) + 1
        names = self.model.tokens + [None] * (size - self.model.size)
        for t, i in self.special.items():
            names[i] = t
        self.names = pa.array(names, pa.string())
        self.kinds = Kinds(self._kind)
        self.alphabet = byte_letters()
        # characters below the first combining one don't compose, so they have one lower-case form wherever they are
        one = self.library.normalizer.normalize_str
        odd = [x for x in map(chr, range(128, COMBINING)) if len(x.lower()) != 1
               or one(x) != x.lower() and (one(x).strip(" ") or self._kind(x) != BREAK)]
        self.odd = re.compile(f"[{re.escape(chr(COMBINING))}-\U0010ffff{re.escape(''.join(odd))}]")
        self.memory = Memory(lambda new: self.model.encode([w.encode().decode("latin-1").translate(self.alphabet) for w in new]))

    @staticmethod
    def _cuts_words(pre: dict) -> bool:
        # fixed value: the pattern by which the words are cut here
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        steps = pre.get("pretokenizers", [])
        return (len(steps) == 2 and steps[0].get("pattern", {}).get("Regex") == pattern and steps[0]["behavior"] == "Removed"
                and steps[0]["invert"] and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])

    def _kind(self, x: str) -> int:
        split = self.library.pre_tokenizer.pre_tokenize_str
        if len(split(f"a{x}a")) == 1:
            return LETTER
        if not split(x):
            return BREAK
        return OTHER if len(split(f"!{x}!")) == 1 else DIGIT

    def words(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Words of normalised texts, and how many each text has."""
        text = "\n".join(texts)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(codes)
        if not n:
            return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
        kind = self.kinds.of(codes)
        starts = np.ones(n, bool)
        starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        # a contraction is cut where a quote starts a run of its own
        for i in np.flatnonzero((codes == 39) & starts).tolist():
            length = contraction(text, i)
            if length:
                starts[i + 1] = False
                if i + length < n:
                    starts[i + length] = True
        at = np.flatnonzero(starts)
        keep = kind[at] != BREAK
        raw = text.encode()
        width = (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000) + np.int8(1)
        edges = np.append((np.cumsum(width, dtype=np.int64) - width)[at], len(raw))
        runs = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edges), pa.py_buffer(raw))
        first = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        of = np.searchsorted(first, at[keep], "right") - 1
        return runs.filter(pa.array(keep)), np.bincount(of, minlength=len(texts))

    def normalise(self, text: str) -> str:
        # these need no composing, and blanks are no part of words
        return text.lower() if text.isascii() or not self.odd.search(text) else self.library.normalizer.normalize_str(text)

    def _parts(self, text: str) -> list[str | int]:
        """Normalised parts of a text, and the ids of the added tokens between them."""
        if self.marks is None or not any(m in text for m in self.special):
            return [self.normalise(text)]
        return [self.special[p] if p in self.special else self.normalise(p) for p in self.marks.split(text) if p]

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """Token ids of each text; a null text has none."""
        parts = [self._parts(t) if t else [] for t in texts]
        flat = [p for x in parts for p in x]
        added = np.array([p if isinstance(p, int) else -1 for p in flat], np.int64)
        many = np.ones(len(flat), np.int64)
        words, many[added < 0] = self.words([p for p in flat if isinstance(p, str)])
        words = words.dictionary_encode()
        place = np.empty(int(many.sum()), np.int64)
        inside = np.repeat(added < 0, many)
        place[inside] = self.memory.places(words.dictionary.to_pylist())[words.indices.to_numpy()]
        # an added token has -1 - its id
        place[~inside] = -1 - added[added >= 0]
        ids, n = self.memory.tokens(place)
        of = np.append(0, np.cumsum(many))[np.cumsum([0, *map(len, parts)])]
        ends = np.append(0, np.cumsum(n))[of]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens' own strings, joined by a space, as the library does where the file names no decoder."""
        names = self.names.take(ids.flatten())
        offsets = ids.offsets
        lists = pa.ListArray.from_arrays(pc.subtract(offsets, offsets[0]), names)
        return pc.binary_join(lists, " ")


def contraction(text: str, at: int) -> int:
    """Length of the English contraction that starts at a quote, or 0."""
    # fixed values: the contractions of the tokenizer's pattern
    for c in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"):
        if text.startswith(c, at):
            return len(c)
    return 0


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    """The file's tokenizer, once for each worker process."""
    return Tokens(path)


def _slices(texts: pa.Array):
    """(start, texts) of slices of about ``SLICE`` characters."""
    start, held, size = 0, [], 0
    for i in range(len(texts)):
        t = texts[i].as_py()
        if held and size + len(t or "") > SLICE:
            yield start, held
            start, held, size = i, [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield start, held


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids`` (array<int>): the tokens of ``text`` by the tokenizer file, without special ones added.

    A string of an added token inside a text is that token, as in the library. Null and empty texts, and texts of blanks alone, have
    no tokens. Rows are independent, so repeated rows have equal results; all other columns stay, but a column
    that has the name ``ids`` is replaced. Texts are read in slices of about ``SLICE`` characters, a longer one alone and whole.
    An empty table gives an empty result.
    """
    rest = [c for c in docs.columns if c != ids]
    (tmp,) = fresh(docs, "ids")
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, T.StructField(tmp, T.ArrayType(T.IntegerType(), False))])
    where = rest.index(text)

    def run(batches):
        for batch in batches:
            for start, held in _slices(batch.column(where)):
                part = batch.slice(start, len(held))
                yield pa.RecordBatch.from_arrays([*part.columns, tokens(path).encode(held)], names=[*part.schema.names, tmp])

    out = docs.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)
    return out.withColumnRenamed(tmp, ids)


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the column ``text``: what the tokenizer file's decoding makes of ``ids``, special tokens included.

    No ids give an empty text, null ids a null. Other columns stay, but one named ``text`` is replaced.
    """
    rest = [c for c in rows.columns if c != text]
    (tmp,) = fresh(rows, "text")
    schema = T.StructType([*rows.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, T.StructField(tmp, T.StringType())])
    where = rest.index(ids)

    def run(batches):
        for batch in batches:
            made = tokens(path).decode(batch.column(where))
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.if_else(batch.column(where).is_null(), pa.scalar(None, pa.string()), made)],
                                             names=[*batch.schema.names, tmp])

    return rows.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema).withColumnRenamed(tmp, text)


@query("op12_bpe_speculative")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    out = decoded(encoded(table(spark, folder, "documents").select("doc_id", "text"), path).drop("text"), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
