"""Substring dedup: recurring passages are confirmed, compiled into sharded Aho-Corasick automata and located everywhere.

Documents are dealt into scopes of a bounded number of bytes. Every window of 13 words has an anchor, the smallest hash
among its shingles of five words, so equal windows have equal anchors.

1. Each scope asks once for each of its anchors whether some other document has it too.
2. Runs of windows with such an anchor are candidate passages. Each scope sends a passage once, with the smallest doc_id that has
   it, to the shard of its anchor. There, windows that recur are compiled into an automaton over words, the shard's
   passages are streamed through it, and each scope is told its windows' smallest doc_id.
3. Each document drops the words of the windows that a smaller doc_id has.

What meets in one shard grows with the number of scopes, not with the number of documents that share a passage. The
texts are shuffled once, as all three steps read the same exchange.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.base import partitions, query, table
from hazeline.llm.words import Words, mix, texts

WINDOW = 13
SHINGLE = 5
SCOPE_BYTES = 8 << 20
#: Words of the passages that one automaton serves; a shard with more of them uses several, each for its own anchors.
AUTOMATON_WORDS = 50_000


def _anchors(w: Words, hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of each window, and the word where it starts."""
    value, place = w.windows(hashes, k)
    spread = window - k
    if len(value) <= spread:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n, low, width = len(value) - spread, value, 1
    while 2 * width <= spread + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = spread + 1 - width
    low = np.minimum(low[:n], low[rest:rest + n])
    whole = w.text[place[:n]] == w.text[place[spread:]]
    # smallest hashes are small numbers: they are mixed again to fall evenly into buckets
    return mix(low[whole]), place[:n][whole]


def _edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(((sorted_hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))


def _batches(part: pa.Table):
    for batch in part.combine_chunks().to_batches():
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        yield batch, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)


_ASK = "bucket int, scope long, tokens binary, marked binary"


def _ask(window: int, k: int, buckets: int):
    def run(part: pa.Table) -> pa.Table:
        found, owners = [], []
        for batch, ids, valid in _batches(part):
            for w in texts(batch, "text"):
                low, place = _anchors(w, w.hashes(), window, k)
                row = w.first + w.text[place]
                keep = valid[row]
                keep[1:] &= (low[1:] != low[:-1]) | (row[1:] != row[:-1])
                found.append(low[keep])
                owners.append(ids[row[keep]])
        scope = part["scope"][0].as_py()
        token, owner = np.concatenate(found or [np.zeros(0, np.uint64)]), np.concatenate(owners or [np.zeros(0, np.int64)])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1])[:len(token)])
        many = np.maximum.reduceat(owner, first) != np.minimum.reduceat(owner, first) if len(first) else np.zeros(0, bool)
        token = token[first]
        at = _edges(token, buckets)
        rows = [(b, token[at[b]:at[b + 1]], many[at[b]:at[b + 1]]) for b in range(buckets) if at[b] < at[b + 1]]
        return pa.table({"bucket": pa.array([b for b, _, _ in rows], pa.int32()), "scope": pa.array([scope] * len(rows), pa.int64()),
                         "tokens": pa.array([t.tobytes() for _, t, _ in rows], pa.binary()),
                         "marked": pa.array([m.tobytes() for _, _, m in rows], pa.binary())})

    return run


def _answer(batches):
    """Anchors that two scopes, or two documents of one scope, have."""
    scopes, tokens, marks = [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            tokens.append(np.frombuffer(row["tokens"], np.uint64))
            marks.append(np.frombuffer(row["marked"], bool))
            scopes.append(np.full(len(tokens[-1]), row["scope"]))
    if not tokens:
        return
    token, mark, scope = np.concatenate(tokens), np.concatenate(marks), np.concatenate(scopes)
    order = np.argsort(token, kind="stable")
    token, mark, scope = token[order], mark[order], scope[order]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    many = np.diff(np.append(first, len(token)))
    shared = np.repeat((many > 1) | np.logical_or.reduceat(mark, first), many)
    token, scope = token[shared], scope[shared]
    order = np.argsort(scope, kind="stable")
    token, scope = token[order], scope[order]
    own, first = np.unique(scope, return_index=True)
    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([t.tobytes() for t in np.split(token, first[1:])] if len(own) else [], pa.binary())], ["scope", "tokens"])


_PASSAGES = "bucket int, scope long, anchors array<long>, passages array<binary>, least array<long>, marked array<boolean>"


def _candidates(window: int, k: int, buckets: int):
    def run(part: pa.Table, told: pa.Table) -> pa.Table:
        known = [np.frombuffer(t, np.uint64) for t in told["tokens"].to_pylist()]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        best: dict[tuple[int, int, bytes], list] = {}
        for batch, ids, valid in _batches(part) if len(known) else ():
            for w in texts(batch, "text"):
                low, place = _anchors(w, w.hashes(), window, k)
                hit = known[np.minimum(np.searchsorted(known, low), len(known) - 1)] == low
                hit &= valid[w.first + w.text[place]]
                low, place = low[hit], place[hit]
                new = np.append(True, (low[1:] != low[:-1]) | (place[1:] != place[:-1] + 1) | (w.text[place[1:]] != w.text[place[:-1]]))[:len(low)]
                start = np.flatnonzero(new)
                end = np.append(start[1:], len(low)) - 1 if len(start) else start
                bucket = ((low[start] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                raw, lo, hi = w.data.tobytes(), w.start[place[start]], w.end[place[end] + window - 1] if len(start) else start
                anchor = low[start].view(np.int64).tolist()
                for b, a, i, j, doc in zip(bucket.tolist(), anchor, lo.tolist(), hi.tolist(), ids[w.first + w.text[place[start]]].tolist()):
                    entry = best.setdefault((b, a, b" ".join(raw[i:j].split())), [doc, False])
                    if doc != entry[0]:
                        entry[0], entry[1] = min(doc, entry[0]), True
        rows: dict[int, list] = {}
        for (b, anchor, text), (doc, many) in best.items():
            rows.setdefault(b, []).append((anchor, text, doc, many))
        scope = part["scope"][0].as_py() if part.num_rows else None
        return pa.table({"bucket": pa.array(list(rows), pa.int32()), "scope": pa.array([scope] * len(rows), pa.int64()),
                         **{c: pa.array([[x[i] for x in r] for r in rows.values()], pa.list_(t)) for i, (c, t) in enumerate(
                             (("anchors", pa.int64()), ("passages", pa.binary()), ("least", pa.int64()), ("marked", pa.bool_())))}})

    return run


def _codes(words: np.ndarray) -> list[str]:
    """Three characters for each word, from three disjoint alphabets, so that matches start and end at words."""
    kinds, number = np.unique(words, return_inverse=True)
    base = 2
    while base ** 3 < len(kinds):
        base += 1
    at = np.arange(len(kinds))
    parts = (at // base ** 2, base + at // base % base, 2 * base + at % base)
    code = ["".join(map(chr, c)) for c in zip(*(np.where(p + 32 < 0xD800, p + 32, p + 0x10000).tolist() for p in parts))]
    return [code[i] for i in number.tolist()]


def _confirmed(passages: list[bytes], scope: np.ndarray, least: np.ndarray, marked: np.ndarray, window: int):
    """(scope, window hash, smallest doc_id) of the recurring windows of some passages, located by one automaton."""
    words, value, owner, where, at = [], [], [], [], 0
    batch = pa.RecordBatch.from_arrays([pa.array(passages, pa.large_binary()).cast(pa.large_string(), safe=False)], ["text"])
    for w in texts(batch, "text"):
        h = w.hashes()
        v, place = w.windows(h, window)
        words.append(h)
        value.append(v)
        where.append(place + at)
        owner.append(w.first + w.text[place])
        at += len(h)
    words, value, owner, where = map(np.concatenate, (words, value, owner, where))
    # confirm: in passages of two scopes or more, or of two documents of a scope
    kinds, first, of, many = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
    recurs = many > 1
    recurs[of[marked[owner]]] = True
    patterns = np.flatnonzero(recurs)
    if not len(patterns):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = _codes(words)
    machine = ahocorasick.Automaton()
    for p, i in zip(patterns.tolist(), where[first[patterns]].tolist()):
        machine.add_word("".join(code[i:i + window]), p)
    machine.make_automaton()
    new = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner))
    hits, counts = [], []
    for lo, hi in zip(where[new[:-1]].tolist(), (where[new[1:] - 1] + window).tolist()):
        found = [p for _, p in machine.iter("".join(code[lo:hi]))]
        hits += found
        counts.append(len(found))
    passage, pattern = np.repeat(owner[new[:-1]], counts), np.array(hits, np.int64)
    lowest = np.full(len(kinds), np.iinfo(np.int64).max)
    np.minimum.at(lowest, pattern, least[passage])
    key = np.unique(np.stack([scope[passage], pattern]), axis=1)
    return key[0], kinds[key[1]], lowest[key[1]]


def _locate(window: int):
    """A shard: confirm windows that recur, compile them, and stream the shard's passages through the automata."""

    def run(batches):
        scope, anchors, passages, least, marked = [], [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                scope += [row["scope"]] * len(row["passages"])
                anchors += row["anchors"]
                passages += row["passages"]
                least += row["least"]
                marked += row["marked"]
        if not passages:
            return
        scope, anchors, least, marked = map(np.array, (scope, anchors, least, marked))
        order = np.argsort(anchors, kind="stable")
        anchors = anchors[order]
        length = np.array([passages[i].count(b" ") + 1 for i in order.tolist()])
        piece = np.cumsum(length) // AUTOMATON_WORDS
        # an anchor's passages stay together
        new = np.append(True, anchors[1:] != anchors[:-1])
        piece = piece[np.flatnonzero(new)][np.cumsum(new) - 1]
        found = [_confirmed([passages[i] for i in own.tolist()], scope[own], least[own], marked[own], window)
                 for own in np.split(order, np.flatnonzero(np.diff(piece)) + 1)]
        where, value, low = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(where, kind="stable")
        where, value, low = where[order], value[order], low[order]
        own, first = np.unique(where, return_index=True)
        if len(own):
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([x.tobytes() for x in np.split(value, first[1:])], pa.binary()),
                 pa.array([x.astype(np.int64).tobytes() for x in np.split(low, first[1:])], pa.binary())], ["scope", "windows", "least"])

    return run


def _kept(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(part: pa.Table, told: pa.Table) -> pa.Table:
        known, least = ([np.frombuffer(x, t) for x in told[c].to_pylist()] for c, t in (("windows", np.uint64), ("least", np.int64)))
        known, least = (np.concatenate(known), np.concatenate(least)) if known else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.lexsort((least, known))
        known, least = known[order], least[order]
        counts, removed, kept = [], [], []
        for batch, ids, valid in _batches(part):
            for w in texts(batch, "text"):
                value, place = w.windows(w.hashes(), window) if len(known) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                if len(known):
                    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                    row = w.first + w.text[place]
                    place = place[(known[at] == value) & (least[at] < ids[row]) & valid[row]]
                n = len(w.start)
                gone = np.cumsum(np.bincount(place, minlength=n + 1) - np.bincount(place + window, minlength=n + 1)[:n + 1])[:n] > 0
                own, lost = w.counts(), np.bincount(w.text[gone], minlength=w.texts)
                first, raw = np.cumsum(own) - own, w.data.tobytes()
                for i in range(w.texts):
                    found = raw[w.bounds[i]:w.bounds[i + 1]].split()
                    if lost[i]:
                        found = [x for x, g in zip(found, gone[first[i]:first[i] + own[i]].tolist()) if not g]
                    kept.append(b" ".join(found))
                counts += own.tolist()
                removed += lost.tolist()
        return pa.table([part["doc_id"].combine_chunks().cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(kept, pa.binary()).cast(pa.string(), safe=False)], schema=schema) if part.num_rows else schema.empty_table()

    return run


def deduplicated(docs: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, scope_bytes: int = SCOPE_BYTES) -> DataFrame:
    """Documents without the words that a document of a smaller doc_id has already: doc_id, n_words, n_removed, kept.

    A word goes if it is in a window of ``window`` words that also starts in a document with a smaller doc_id. ``kept`` has
    the other words, joined by one space. A null text has no words. A row without a doc_id is neither smaller nor larger
    than any: it keeps its words and takes none. Rows that share a doc_id take no words from each other. Other columns are ignored; an
    empty table gives an empty result.
    """
    parts = partitions(docs.sparkSession)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    scope = F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // scope_bytes + 1))
    own = docs.select("doc_id", "text", scope.alias("scope")).repartition(parts, "scope")
    told = (own.groupBy("scope").applyInArrow(_ask(window, shingle, parts), _ASK).repartition(parts, "bucket")
            .mapInArrow(_answer, "scope long, tokens binary"))
    asked = own.groupBy("scope").cogroup(told.groupBy("scope")).applyInArrow(_candidates(window, shingle, parts), _PASSAGES)
    found = asked.repartition(parts, "bucket").mapInArrow(_locate(window), "scope long, windows binary, least binary")
    return (own.groupBy("scope").cogroup(found.groupBy("scope"))
            .applyInArrow(_kept(window), "doc_id long, n_words long, n_removed long, kept string"))


SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS g
  FROM words WHERE len(w) >= 13),
firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (
  SELECT w.doc_id, unnest(range(i, i + 13)) AS j FROM windows w JOIN firsts f USING (g) WHERE f.least < w.doc_id) GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(w.w) AS n, len(coalesce(js, [])) AS m,
    CASE WHEN js IS NULL THEN w.w ELSE list_filter(w.w, lambda x, i: NOT list_contains(js, i)) END AS k
  FROM words w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept"""


@query("op1_substring_dedup", SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    out = deduplicated(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
