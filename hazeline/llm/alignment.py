"""Alignment of the tokens of two tokenizers by byte ranges.

Both tokenizers cut the same bytes. Texts are cut into units where no token of either side can cross, and each distinct unit of a
task is aligned once: ``merge_asof`` keyed by unit finds for each token of one side the token of the other that covers its first
byte; the union of both directions is all pairs that overlap. Pairs whose ranges end together are links, and their ends cut the
unit into groups. A text has those of its units.

How often an id pair is linked in all documents takes a second step. A batch asks once for each of its distinct pairs, so the
pairs are summed, ranked and joined by Spark with at most one row a batch and pair; what it learns goes back to the batch,
where the links of each document are looked up. No table of pairs is held in one place.
"""

from __future__ import annotations

import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.base import query, table
from hazeline.llm.bpe import BREAK, DIGIT, LETTER, OTHER, WORDS, Kinds, Places, byte_letters, contraction
from hazeline.session import materialise

#: Characters of text that are cut at once, and that share one question about their pairs; a longer text is handled alone.
SLICE = 400_000
BATCH = 4_000_000
#: A pair of ids is a * _SIDE + b.
_SIDE = 1 << 32
#: Characters of distinct units that a task remembers with their groups and links, some 40 bytes each.
MEMORY = 2_500_000


class ByteLevel:
    """A byte-level tokenizer file whose words are letters, digits or others, each with the blank before it.

    Words are cut as arrays and merged by the library's model. The tokens of a word are its bytes, whatever they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kinds = Kinds(self._kind)
        self.letters = byte_letters()
        back = {c: b for b, c in self.letters.items()}
        size = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        names = [self.library.id_to_token(i) or "" for i in range(size)]
        self.bytes = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in names]

    def _kind(self, x: str) -> int:
        split = self.library.pre_tokenizer.pre_tokenize_str
        probes = ((f"a{x}a", LETTER), (f"1{x}1", DIGIT), (f"!{x}!", OTHER))
        return next((k for text, k in probes if len(split(text)) == 1), BREAK)

    def _starts(self, text: str, codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether a word starts at each character."""
        n = len(codes)
        starts = np.ones(n, bool)
        starts[1:] = kind[1:] != kind[:-1]
        # the last blank before a word stands alone, and belongs to the word if it is a space
        last = np.flatnonzero((kind[:-1] == BREAK) & (kind[1:] != BREAK))
        starts[last] = True
        starts[last[codes[last] == 32] + 1] = False
        for i in np.flatnonzero((codes == 39) & starts).tolist():
            length = contraction(text, i)
            if length:
                starts[i + 1] = False
                if i + length < n:
                    starts[i + length] = True
        return starts

    def cuts(self, text: str, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Those of the places ``at`` where words end, and where a text that ends there has the same words."""
        kind = self.kinds.of(codes)
        free = self._starts(text, codes, kind)
        # how blanks before a word are cut depends on the word
        free[2:] &= (kind[2:] == BREAK) | (kind[1:-1] != BREAK) | (kind[:-2] != BREAK)
        return at[free[at]]

    def encode(self, units: list[str]) -> list[list[int]]:
        whole, cut = "".join(units), self.library.model.tokenize
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kind = self.kinds.of(codes)
        n = np.fromiter(map(len, units), np.int64, len(units))
        first, unit = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        # characters of one kind, after a space or not, are one word
        turn = np.zeros(len(codes), bool)
        turn[1:] = kind[1:] != kind[:-1]
        turn[first] = False
        turn[first[(codes[first] == 32) & (n > 1)] + 1] = False
        mixed = np.bincount(unit[turn], minlength=len(n)) > 0
        size = np.append(0, np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)))
        written = whole.encode().decode("latin-1").translate(self.letters)
        out = []
        for u, s, e, m in zip(units, size[first].tolist(), size[first + n].tolist(), mixed.tolist()):
            if not m:
                out.append([t.id for t in cut(written[s:e])])
                continue
            codes = np.frombuffer(u.encode("utf-32-le"), np.uint32)
            at = np.flatnonzero(self._starts(u, codes, self.kinds.of(codes))).tolist()
            words = [u[i:j].encode().decode("latin-1").translate(self.letters) for i, j in zip(at, [*at[1:], len(u)])]
            out.append([t.id for w in words for t in cut(w)])
        return out


class Pieces:
    """A sentencepiece file that adds a space before the text.

    No merge crosses from a character to the next if no piece has these two next to each other, so texts may be cut there, unless
    the file rewrites them.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.blank = [self.library.piece_to_id("▁")]
        met = [p for i, p in enumerate(names) if not (self.library.is_byte(i) or self.library.is_control(i))]
        # a character without a piece, put before what doesn't start with a space, keeps the added space away from it
        self.mark = next((c for c in map(chr, range(1, 32)) if not any(c in p for p in met)), None)
        probe = f" ﬁ e\u0301 \t  Ａ{self.mark}\n "
        self.plain = self.mark is not None and self.library.normalize(probe) == "▁" + probe.replace(" ", "▁")
        self.before = len(self.library.encode(self.mark)) if self.plain else 0
        near = {(ord(x) << 21) | ord(y) for p in met for x, y in zip(p.replace("▁", " "), p.replace("▁", " ")[1:])}
        self.pairs = np.array([*sorted(near), 1 << 42], np.int64)

    def cuts(self, text: str, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Those of the places ``at`` that no token crosses."""
        if not self.plain:
            return at[:0]
        near = (codes[at - 1].astype(np.int64) << 21) | codes[at]
        return at[self.pairs[np.searchsorted(self.pairs, near)] != near]

    def encode(self, units: list[str]) -> list[list[int]]:
        # a unit's first blank is the one that the library adds; to an empty text it adds none
        found = self.library.encode([u[1:] if u[0] == " " else self.mark + u for u in units], num_threads=1)
        return [(ids or self.blank) if u[0] == " " else ids[self.before:] for u, ids in zip(units, found)]


class Side:
    """A tokenizer with the bytes of each of its tokens, and how its ids are written."""

    def __init__(self, path: str):
        self.model = ByteLevel(path) if path.endswith(".json") else Pieces(path)
        self.bytes = np.array([*self.model.bytes, None], object)[:-1]
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self.comma, self.bar, self.semicolon, self.plain = (np.array([f"{i}{mark}" for i in range(len(self.bytes))], object)
                                                            for mark in (",", "|", ";", ""))

    def cut(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, how many of each unit, whether a unit's tokens make up its bytes)."""
        lists = self.model.encode(units)
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))
        whole, raw = b"".join(self.bytes[ids].tolist()), [u.encode() for u in units]
        ends = np.append(0, np.cumsum(self.length[ids]))[np.cumsum(n)]
        if whole == b"".join(raw) and (ends == np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))).all():
            return ids, n, np.ones(len(units), bool)
        return ids, n, np.array([whole[i:j] == r for i, j, r in zip([0, *ends.tolist()], ends.tolist(), raw)], bool)


@lru_cache(maxsize=4)
def side(path: str) -> Side:
    """A tokenizer file's side, once for each worker process."""
    return Side(path)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of tokens that share a byte: their rows (a, b) and ends (end_a, end_b).

    Both frames have doc, start and end of non-empty tokens, ordered by start, where starts of a later document are larger.
    """
    a, b = a.assign(a=np.arange(len(a))), b.assign(b=np.arange(len(b)))
    left = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    # tokens that start together were found in the first direction
    at = a["start"].to_numpy()
    later = at[np.searchsorted(at, b["start"].to_numpy(), "right") - 1] != b["start"].to_numpy() if len(at) else np.zeros(len(b), bool)
    right = pd.merge_asof(b[later], a, on="start", by="doc", suffixes=("_b", "_a"))
    return pd.concat([left, right])[["a", "b", "end_a", "end_b"]]


def _cut(units: list[str], first: Side, second: Side):
    """For both sides: how many tokens a unit has, all ids, and their ranges; only of units that both give back. Last, which these are."""
    found = [s.cut(units) for s in (first, second)]
    good = found[0][2] & found[1][2]
    out = []
    for s, (ids, n, _) in zip((first, second), found):
        ids, n = ids[np.repeat(good, n)], np.where(good, n, 0)
        end = np.cumsum(s.length[ids])
        out.append((n, ids, pd.DataFrame({"doc": np.repeat(np.arange(len(n)), n), "start": end - s.length[ids], "end": end})))
    return *out, good


def _groups(flat_a, flat_b, last_a, last_b, doc_a, doc_b, first: Side, second: Side, texts: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each text, where ``last_a`` and ``last_b`` are the last tokens of the groups."""
    n, m = len(flat_a), len(flat_b)
    ends_a, ends_b = np.zeros(n, np.int64), np.zeros(m, np.int64)
    ends_a[last_a] = 1
    ends_b[last_b] = 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    sizes_a, sizes_b = np.append(0, last_a + 1), np.append(0, last_b + 1)
    # a token comes after the tokens of its side and those groups of the other side that are before it
    place_a, place_b = np.arange(n) + sizes_b[group_a], np.arange(m) + sizes_a[group_b + 1]
    out = np.empty(n + m, object)
    out[place_a] = np.where(ends_a == 1, first.bar[flat_a], first.comma[flat_a])
    final = np.ones(m, bool)
    final[:-1] = doc_b[1:] != doc_b[:-1]
    out[place_b] = np.where(final, second.plain[flat_b], np.where(ends_b == 1, second.semicolon[flat_b], second.comma[flat_b]))
    stop = np.cumsum(np.bincount(doc_a, minlength=texts) + np.bincount(doc_b, minlength=texts)).tolist()
    cells, start, made = out.tolist(), 0, []
    for s in stop:
        made.append("".join(cells[start:s]))
        start = s
    return made


def _units_linked(units: list[str], first: Side, second: Side) -> tuple[np.ndarray, list[str], np.ndarray]:
    """For each unit: tokens of both sides, links, overlaps and whether both sides give it back; its groups; all links as id pairs."""
    (n_a, flat_a, a), (n_b, flat_b, b), good = _cut(units, first, second)
    pairs = overlaps(a, b)
    doc_a, doc_b = a["doc"].to_numpy(), b["doc"].to_numpy()
    shared = np.bincount(doc_a[pairs["a"].to_numpy(np.int64)], minlength=len(units))
    # non-empty ranges that end together overlap, so no link is missed; a token ends with one token at most
    links = pairs[pairs["end_a"] == pairs["end_b"]].sort_values("a")
    last_a, last_b = links["a"].to_numpy(np.int64), links["b"].to_numpy(np.int64)
    n = np.bincount(doc_a[last_a], minlength=len(units))
    text = _groups(flat_a, flat_b, last_a, last_b, doc_a, doc_b, first, second, len(units))
    return np.array([n_a, n_b, n, shared, good], np.int64), text, flat_a[last_a] * _SIDE + flat_b[last_b]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, with room for so many columns."""
    while array.shape[-1] < size:
        array = np.concatenate([array, np.zeros_like(array)], axis=-1)
    return array


class Units:
    """Cuts texts where no token of either side crosses, and aligns each distinct unit once, as texts repeat their words.

    What units have is remembered up to ``MEMORY`` characters of units; then it starts anew.
    """

    def __init__(self, first: Side, second: Side):
        self.sides = first, second
        self._forget()

    def _forget(self) -> None:
        self.known, self.held = Places(), 0
        self.numbers, self.text = np.zeros((5, 1 << 10), np.int32), np.zeros(1 << 10, object)
        self.first, self.links = np.zeros(1 << 10, np.int64), np.zeros(1 << 12, np.int64)

    def of(self, text: str) -> list[str]:
        """The units of a text with a space before it, which they make up."""
        text = " " + text
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.arange(1, len(codes))
        for s in self.sides:
            at = s.model.cuts(text, codes, at)
        at = at.tolist()
        return [text[i:j] for i, j in zip([0, *at], [*at, len(text)])]

    def places(self, units: list[str]) -> np.ndarray:
        """Where the units' numbers, groups and links are."""
        if self.held > MEMORY:
            self._forget()
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        new, self.known.new = self.known.new, []
        have = self.known.many - len(new)
        for start in range(0, len(new), WORDS):
            part = new[start:start + WORDS]
            numbers, text, links = _units_linked(part, *self.sides)
            stop, at_link = have + len(part), int(self.first[have])
            self.numbers, self.text = _room(self.numbers, stop), _room(self.text, stop)
            self.first, self.links = _room(self.first, stop + 1), _room(self.links, at_link + len(links))
            self.numbers[:, have:stop], self.text[have:stop] = numbers, text
            self.first[have + 1:stop + 1] = at_link + np.cumsum(numbers[2])
            self.links[at_link:at_link + len(links)] = links
            have = stop
            self.held += sum(map(len, part))
        return at


@lru_cache(maxsize=2)
def units(first: Side, second: Side) -> Units:
    """What both sides make of units, once for each worker process."""
    return Units(first, second)


def _linked(texts: list[str | None], first: Side, second: Side) -> tuple[dict, np.ndarray, np.ndarray]:
    """Columns for each text, and the links as text and id pair."""
    memory = units(first, second)
    lists = [memory.of(t) if t else [] for t in texts]
    at = memory.places([u for x in lists for u in x])
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in lists])
    # bytes that a side changes in one unit are not changed back by another, so a text is given back if all its units are
    whole = np.bincount(doc[memory.numbers[4, at] == 0], minlength=len(texts)) == 0
    at, doc = at[whole[doc]], doc[whole[doc]]
    ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
    n_a, n_b, n, shared = (np.diff(np.append(0, np.cumsum(x, dtype=np.int64))[np.append(0, ends)]) for x in memory.numbers[:4, at])
    many = memory.numbers[2, at]
    start = np.cumsum(many, dtype=np.int64) - many
    links = memory.links[np.arange(int(many.sum())) + np.repeat(memory.first[at] - start, many)]
    cells, before, made = memory.text[at].tolist(), 0, []
    for e in ends.tolist():
        made.append(";".join(cells[before:e]))
        before = e
    # each end that both sides share ends a group, and two tokens link where they end together: as many groups as links
    return {"n_a": n_a, "n_b": n_b, "n_groups": n, "n_links": n, "n_overlaps": shared, "groups": made}, np.repeat(doc, many), links


_DOC = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_overlaps", pa.int64()), ("groups", pa.string())]
_OUT = pa.schema([("batch", pa.string()), ("doc_id", pa.int64()), *_DOC, ("codes", pa.list_(pa.int32())),
                  ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_OUT_SQL = ("batch string, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups string, "
            "codes array<int>, pairs array<long>, counts array<long>")


def _flush(held: list) -> pa.RecordBatch:
    """Rows of documents, whose links are numbers of pairs of their batch, and last a row with these pairs."""
    batch = uuid.uuid4().hex
    links = [x[3] for x in held]
    code, known = pd.factorize(np.concatenate(links))
    counts = np.bincount(code, minlength=len(known))
    columns = {c: [v for x in held for v in x[1][c]] + [None] for c, _ in _DOC}
    of, before = [], 0
    for ids, _, where, _ in held:
        of.append(where + before)
        before += len(ids)
    ends = np.append(0, np.cumsum(np.bincount(np.concatenate(of), minlength=before)))
    codes = pa.ListArray.from_arrays(pa.array(np.append(ends, ends[-1]), pa.int32()), pa.array(code, pa.int32()))
    empty = [[]] * before
    arrays = {"batch": [batch] * (before + 1), "doc_id": [i for x in held for i in x[0]] + [None], **columns, "codes": codes,
              "pairs": empty + [known], "counts": empty + [counts]}
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in zip(_OUT, (arrays[f.name] for f in _OUT))],
                                      schema=_OUT)


def _align(first: str, second: str):
    def run(batches):
        one, two = side(first), side(second)
        held, size = [], 0

        def add(ids, texts):
            held.append((ids, *_linked(texts, one, two)))

        for rows in batches:
            ids, texts, room = [], [], 0
            for i, t in zip(rows.column("doc_id").to_pylist(), rows.column("text")):
                t = t.as_py()
                if texts and room + len(t or "") > SLICE:
                    add(ids, texts)
                    ids, texts, size, room = [], [], size + room, 0
                    if size > BATCH:
                        yield _flush(held)
                        held, size = [], 0
                ids.append(i)
                texts.append(t)
                room += len(t or "")
            if texts:
                add(ids, texts)
                size += room
        if held:
            yield _flush(held)

    return run


def _summed(docs: pa.Table, told: pa.Table) -> pa.Table:
    """Each document's links with the counts of their pairs."""
    many = max(pc.max(told["code"]).as_py() + 1, 0) if told.num_rows else 0
    count, best = np.zeros(many + 1, np.int64), np.zeros(many + 1, np.int64)
    at = told["code"].to_numpy()
    count[at], best[at] = told["count"].to_numpy(), told["best"].to_numpy()
    codes = docs["codes"].combine_chunks()
    links = codes.flatten().to_numpy()
    ends = np.append(0, np.cumsum(codes.value_lengths().to_numpy()))
    run = [np.append(0, np.cumsum(x[links]))[ends] for x in (best, count)]
    return pa.table([docs["doc_id"], *[docs[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256")],
                     *[pa.array(np.diff(x), pa.int64()) for x in run]],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "n_best", "count_sum"])


def aligned(docs: DataFrame, first: str, second: str) -> DataFrame:
    """How the tokens of two tokenizer files cut the texts of ``docs`` (doc_id, text): a row for each batch's documents and pairs.

    Rows with null ``n_a`` hold the batch's distinct id pairs (a * 2^32 + b) that are linked, and how often. The others are
    documents: token counts, groups, links, overlaps, the groups as text, and the links in order as places in ``pairs``.
    A null or empty text, or one that either side doesn't give back byte by byte, has no tokens. Other columns are ignored.
    Each file is a byte-level .json or a sentencepiece .model that adds a space before the text.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_align(first, second), _OUT_SQL)


def weighed(stored: DataFrame) -> DataFrame:
    """One row a document of stored ``aligned`` rows: its counts, ``n_best`` and ``count_sum``.

    A link's count is how many links of all documents have its id pair; it is best where no pair of the same second id has
    more. Documents without links have zeros. ``groups_sha256`` is passed on.
    """
    asked = stored.where("n_a IS NULL").select("batch", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "x")).select(
        "batch", "code", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    counts = materialise(asked.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    other = F.col("pair") % F.lit(_SIDE)
    most = counts.groupBy(other.alias("b")).agg(F.max("count").alias("most"))
    ranked = counts.join(most, other == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    told = asked.select("batch", "code", "pair").join(ranked, "pair").select(F.col("batch").alias("asker"), "code", "count", "best")
    docs = stored.where("n_a IS NOT NULL").drop("pairs", "counts")
    return docs.groupBy("batch").cogroup(told.groupBy("asker")).applyInArrow(
        _summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, n_best long, count_sum long")


def token_alignment(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Alignment of ``docs`` (doc_id, text) by two tokenizer files, one row for each of its rows, with ``groups_sha256``.

    Repeated rows and null ids have rows of their own; repeated texts count as often as they occur. Ties for the highest
    count are all best. An empty table gives an empty result. A very long text is cut and aligned whole, by itself.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return weighed(materialise(aligned(docs, first, second).withColumn("groups_sha256", digest).drop("groups"), "aligned"))


@query("op11_token_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    first, second = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment(table(spark, folder, "documents"), first, second)
