"""Benchmark decontamination by edit distance, with CGK walks and bit sampling.

Texts are sequences of lower-cased words without punctuation, and distance is the edit distance between such sequences.

A CGK walk reads a sequence from its start: at each step it notes the word it is on and moves on or stays, as a random function of
step and word says. Two sequences that differ by few edits soon read the same words at the same steps again, so edit distance
becomes Hamming distance. Sampling the words noted at a few steps hashes near sequences alike. Every benchmark item is hashed by as
many walks as its length and its allowed edits need to reach the target recall, and item-sized windows of documents are
hashed by the same walks; a window with a hash of an item is verified by exact edit distance.

Walking from every word of every document would be waste: an occurrence keeps some of the item's rarest shingles (as many of
them are looked for as the allowed edits can't all destroy), and only windows that such a shingle places are walked.
``exact=True`` verifies these windows without walks; it loses nothing, and tests measure recall against it. Benchmarks
are handled in blocks of a bounded size, each carried to one pass over the documents.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm.base import query, table
from hazeline.llm.words import Words, mix, texts

SIMILARITY = 0.75
#: Bytes of benchmark text that one pass over the documents carries.
BLOCK_BYTES = 16 << 20
SHORT = 8
#: Share of occurrences with all allowed edits that the walks of an item are to find, and the steps that a walk compares.
RECALL = 0.99
SAMPLED = 2
_ITEMS = T.StructField("__items", T.ArrayType(T.LongType()))


def edits(n: int, similarity: float = SIMILARITY) -> int:
    """Edits allowed for an item of ``n`` words; one of fewer than eight must match exactly."""
    return int(n * (1 - similarity) + 1e-9) if n >= SHORT else 0


def distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to a run of ``words``, and where that run ends."""
    row, reach = np.zeros(len(words) + 1, np.int64), np.arange(len(words) + 1)
    for i, x in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (words != x))
        row = np.minimum.accumulate(new - reach) + reach
    end = int(row.argmin())
    return int(row[end]), end


def beginning(item: np.ndarray, words: np.ndarray, far: int) -> int:
    """Where the shortest run at the end of ``words`` begins that is ``far`` edits from the item, the least there is."""
    back = words[::-1][:len(item) + far]
    row = reach = np.arange(len(back) + 1)
    for i, x in enumerate(item[::-1], 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (back != x))
        row = np.minimum.accumulate(new - reach) + reach
    return len(words) - int(row.argmin())


def _walked(h: np.ndarray, start: np.ndarray, end: np.ndarray, moves: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the words noted at the steps ``stops`` (ascending) of each walk, and whether it had not ended by then.

    Walk i reads ``h`` from ``start[i]`` up to ``end[i]`` and moves at step s by the top bit of word * ``moves[i, s]``.
    """
    at, key, alive = start.copy(), np.zeros(len(start), np.uint64), start < end
    rows, noted = np.flatnonzero(alive), np.zeros(len(start), np.int64)
    for s in range(moves.shape[1]):
        if not len(rows):
            break
        word = h[at[rows]]
        note = stops[rows, noted[rows]] == s
        if note.any():
            r = rows[note]
            key[r] = mix(key[r] + word[note] * np.uint64(_NOTE))
            noted[r] += 1
            go = ~(note & (noted[rows] == stops.shape[1]))
            rows, word = rows[go], word[go]
        at[rows] += (word * moves[rows, s] >> np.uint64(63)).astype(np.int64)
        ended = at[rows] >= end[rows]
        alive[rows[ended]] = False
        rows = rows[~ended]
    return key, alive & (noted == stops.shape[1])


_NOTE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1 << 12)
def walks(n: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(moves, stops) of the first ``many`` walks for sequences of ``n`` words.

    Steps are sampled from those before a walk can be expected to end, so ends are not compared.
    """
    steps = max(1, int(2 * n - 4 * np.sqrt(n)) if n >= SHORT else n)
    moves, stops = [], []
    for w in range(many):
        rng = np.random.default_rng((n, w))
        moves.append(rng.integers(0, 1 << 63, steps, np.uint64) << np.uint64(1) | np.uint64(1))
        stops.append(np.sort(rng.choice(steps, min(SAMPLED, steps), replace=False)))
    return np.array(moves), np.array(stops)


@lru_cache(maxsize=1 << 14)
def needed(n: int, d: int, target: float = RECALL, trials: int = 40, tried: int = 256) -> int:
    """Walks that find the share ``target`` of sequences with ``d`` random edits, by trials on random words.

    A trial's chance for one walk is measured with ``tried`` walks; an equal window is walked alike, so one is enough without edits.
    """
    if not d:
        return 1
    rng, chance = np.random.default_rng((n, d)), []
    moves, stops = (np.vstack([x, x]) for x in walks(n, tried))
    start = np.repeat([0, n], tried)
    for _ in range(trials):
        item = rng.integers(1, 1 << 62, n, np.uint64)
        other = item.tolist()
        for _ in range(d):
            kind, at = int(rng.integers(3)), int(rng.integers(max(1, len(other))))
            other[at:at + (kind != 1)] = [int(rng.integers(1, 1 << 62))] if kind != 2 else []
        other = (other + rng.integers(1, 1 << 62, n, np.uint64).tolist())[:n]
        key, good = _walked(np.concatenate([item, np.array(other, np.uint64)]), start, start + n, moves, stops)
        chance.append(((key[:tried] == key[tried:]) & good[:tried] & good[tried:]).mean())
    miss, many = 1 - np.maximum(chance, 0.5 / tried), 1
    while 1 - (miss ** many).mean() < target:
        many += 1
    return many


class Items:
    """A block of benchmark items as arrays: the words of each item, its shingles with their places, and the hashes of its walks."""

    def __init__(self, rows: list[tuple[int, str]], exact: bool = False):
        batch = pa.RecordBatch.from_pydict({"text": pa.array([t for _, t in rows], pa.string())})
        found: list[np.ndarray] = []
        for w in texts(batch, "text", lower=True, alnum=True):
            h, counts = w.hashes(), w.counts()
            found += np.split(h, np.cumsum(counts)[:-1])
        self.exact = exact
        self.ids = np.array([i for (i, _), x in zip(rows, found) if len(x)])
        self.words = [x for x in found if len(x)]
        self.length = np.array([len(x) for x in self.words], np.int64)
        self.edits = np.array([edits(n) for n in self.length], np.int64)
        # the longest run that stays whole, at most three words
        self.gram = np.array([max(1, min(3, -(-(n - d) // (d + 1)))) for n, d in zip(self.length, self.edits)], int)
        self.least = np.maximum(1, self.length - self.gram + 1 - self.edits * self.gram)
        self.tables = {}
        for k in sorted(set(self.gram.tolist())):
            grams = {i: self._grams(i, k) for i in np.flatnonzero(self.gram == k).tolist()}
            common, counts = np.unique(np.concatenate([v for v, _ in grams.values()]), return_counts=True)
            value, item, place = [], [], []
            for i, (v, p) in grams.items():
                # without these shingles there are fewer left than an occurrence must have
                order = np.argsort(counts[np.searchsorted(common, v)], kind="stable")[:max(1, len(v) - self.least[i] + 1)]
                value.append(v[order])
                place.append(p[order])
                item.append(np.full(len(order), i))
            value, item, place = map(np.concatenate, (value, item, place))
            order = np.argsort(value, kind="stable")
            sieve = np.zeros(1 << 20, bool)
            sieve[(value >> np.uint64(44)).astype(np.int64)] = True
            self.tables[k] = (value[order], item[order], place[order], sieve)
        if not exact and len(self.words):
            self._hash()

    def _grams(self, i: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        own = Words(0, 1, np.zeros(0, np.uint8), *[np.zeros(0, np.int64)] * 2, np.zeros(self.length[i], np.int64), np.zeros(2, np.int64))
        return own.windows(self.words[i], k)

    def _hash(self) -> None:
        key, item = [], []
        self.walks = {n: needed(n, d) for n, d in sorted(set(zip(self.length.tolist(), self.edits.tolist())))}
        for n, many in self.walks.items():
            moves, stops = walks(n, many)
            for i in np.flatnonzero(self.length == n).tolist():
                k, good = _walked(self.words[i], np.zeros(len(moves), np.int64), np.full(len(moves), n), moves, stops)
                key.append(_named(k, n, np.arange(len(moves)))[good])
                item.append(np.full(int(good.sum()), i))
        key, item = np.concatenate(key), np.concatenate(item)
        order = np.argsort(key, kind="stable")
        self.keys, self.owner = key[order], item[order]

    def _selected(self, h: np.ndarray, start: np.ndarray, length: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) where a window of ``length`` words has a hash of the item."""
        window, item = [], []
        for n in np.unique(length).tolist():
            moves, stops = walks(n, self.walks[n])
            own = np.flatnonzero(length == n)
            # as many windows at once as make some hundred thousand walks
            for part in np.split(own, range(0, len(own), max(1, (1 << 18) // len(moves)))[1:]):
                w, t = np.repeat(part, len(moves)), np.tile(np.arange(len(moves)), len(part))
                key, good = _walked(h, start[w], np.minimum(start[w] + n, stop[w]), moves[t], stops[t])
                key, w = _named(key, n, t)[good], w[good]
                lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
                many = hi - lo
                window.append(np.repeat(w, many))
                item.append(self.owner[np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))])
        both = np.unique(np.stack([np.concatenate(window), np.concatenate(item)]), axis=1)
        return both[0], both[1]

    def matches(self, w: Words):
        """(text, item number, distance, first word, end word) for a chunk of documents."""
        h = w.hashes()
        first = np.searchsorted(w.text, np.arange(w.texts + 1))
        hits = []
        for k, (value, item, place, sieve) in self.tables.items():
            v, at = w.windows(h, k)
            some = sieve[(v >> np.uint64(44)).astype(np.int64)]
            v, at = v[some], at[some]
            lo, hi = np.searchsorted(value, v, "left"), np.searchsorted(value, v, "right")
            many = hi - lo
            index = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            hits.append(np.stack([np.repeat(w.text[at], many), item[index], np.repeat(at, many) - place[index]]))
        hits = np.concatenate(hits, 1)
        if not hits.shape[1]:
            return
        text, item, start = hits
        # an occurrence at the edge of a text may begin before it by as many words as were left out
        start = np.maximum(start, first[text])
        hits = np.unique(np.stack([text, item, start]), axis=1)
        if not self.exact:
            text, item, start = hits
            windows, of = np.unique(np.stack([text, start, self.length[item]]), axis=1, return_inverse=True)
            window, found = self._selected(h, windows[1], windows[2], first[windows[0] + 1])
            hits = np.unique(np.stack([windows[0][window], found, windows[1][window]]), axis=1)
            if not hits.shape[1]:
                return
        ends = np.flatnonzero((np.diff(hits[:2], axis=1) != 0).any(0)) + 1
        for part in np.split(hits, ends, axis=1):
            t, i, start = int(part[0, 0]), int(part[1, 0]), part[2]
            n, d = int(self.length[i]), int(self.edits[i])
            lo, hi = int(first[t]), int(first[t + 1])
            # an occurrence holds a shingle that is at most d places off; windows that overlap are searched as one run
            apart = np.flatnonzero(np.diff(start) > n + 2 * d)
            best = None
            for s, e in zip(start[np.r_[0, apart + 1]].tolist(), start[np.r_[apart, -1]].tolist()):
                a, b = max(lo, s - d), min(hi, e + n + d)
                far, end = distance(self.words[i], h[a:b])
                if far <= d and (best is None or far < best[0]):
                    best = (far, a + beginning(self.words[i], h[a:a + end], far) - lo, a + end - lo)
            if best:
                yield t, i, *best


def _named(key: np.ndarray, n: int, walk: np.ndarray) -> np.ndarray:
    """A hash of a walk's notes that no other length or walk shares."""
    return mix(key ^ mix(np.uint64(n * _NOTE % (1 << 64)) + walk.astype(np.uint64)))


def _scan(items: Items):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            rows = [(ids[w.first + t].as_py(), int(items.ids[i]), far, a, b)
                    for w in texts(batch, "text", lower=True, alnum=True) for t, i, far, a, b in items.matches(w)] if len(items.words) else []
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def _blocks(benchmark: DataFrame, block_bytes: int, exact: bool = False):
    """Blocks of items, each of a bounded size, as one broadcast each."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = size // block_bytes + 1
    for b in range(blocks):
        own = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield Items([(r["item_id"], r["text"]) for r in own.distinct().orderBy("item_id", "text").collect()], exact)


def matches(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, exact: bool = False) -> DataFrame:
    """(doc_id, item_id, edits, start, stop): items that occur in a document, in words, with their least distance found.

    Null texts and texts or items without words match nothing; items without an id are left out; a document's row without an id gives rows with a null
    id. Repeated rows match each for itself. Empty tables give an empty result. Other columns are ignored.
    """
    out = None
    for items in _blocks(benchmark, block_bytes, exact):
        part = docs.select("doc_id", "text").mapInArrow(_scan(items), "doc_id long, item_id long, edits long, start long, stop long")
        out = part if out is None else out.unionByName(part)
    return out


def _flag(items: Items):
    def run(batches):
        for batch in batches:
            hit: dict[int, set] = {}
            for w in texts(batch, "text", lower=True, alnum=True):
                for t, i, *_ in items.matches(w) if len(items.words) else ():
                    hit.setdefault(w.first + t, set()).add(int(items.ids[i]))
            lists = pa.array([sorted(hit.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "__items"])

    return run


def flagged(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, exact: bool = False) -> DataFrame:
    """``docs`` with one more column ``__items``: the sorted ids of the items that occur in a row's text (none: empty).

    One pass for each block of the benchmark. Rows are as for ``matches``; all columns stay.
    """
    out, names = None, docs.columns
    for items in _blocks(benchmark, block_bytes, exact):
        if out is None:
            out = docs.mapInArrow(_flag(items), T.StructType([*docs.schema.fields, _ITEMS]))
        else:
            more = out.withColumnRenamed("__items", "__before")
            grown = more.mapInArrow(_flag(items), T.StructType([*more.schema.fields, _ITEMS]))
            out = grown.select(*names, F.array_sort(F.array_union("__before", "__items")).alias("__items"))
    return out


@query("op8_decontaminate_cgk")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = flagged(docs, table(spark, folder, "benchmark"))
    return out.select("doc_id", (F.size("__items") > 0).cast("int").alias("contaminated"), F.size("__items").cast("long").alias("n_items"),
                      F.array_join(F.transform("__items", lambda x: x.cast("string")), ",").alias("item_ids"))
