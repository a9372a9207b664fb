"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

1. ``shared_sets``: for each distinct set, the shingles that some other set has as well. Shingles are dealt out by hash as
   packed arrays. A map task asks once for each of its shingles, however many of its sets hold it, so no shingle has more
   entries in one place than there are map tasks.
2. A set of n shingles needs ceil(0.75 n) of them in a partner. Sets that share fewer with anybody have no links.
3. All others meet by signatures. A light set (n up to the boundary) enumerates the 2-subsets of its prefix of
   ``shared - ceil(0.75 n) + 2`` shingles; a heavy one scans the inverted lists of its prefix of one shingle less. Two partners always agree
   on such a subset or list. The boundary is the power of two with the least cost: subsets made against list entries read.
4. Prefixes are taken in the order of how many sets have a shingle, the rarest first (``ranked``).
5. Candidates are verified on the sets, first against one hub of each list. The second round compares only sets that are in
   different components yet, which loses no component and doesn't make all pairs of a group of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm.base import partitions, query, table
from hazeline.llm.graphs import components
from hazeline.llm.words import mix, texts
from hazeline.session import materialise

WORDS = 5
PERCENT = 75
#: Shingles that a map task holds at once before it sends them on.
HELD = 3_000_000
#: Shared shingles that a reduce task holds at once before it sends them on, or folds equal ones.
MOST = 1_000_000


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    for w in texts(batch, "text", lower=True):
        h, counts = w.hashes(), w.counts()
        first = np.cumsum(counts) - counts
        value, place = w.windows(h, k)
        cut = np.searchsorted(place, np.append(first, len(h)))
        for i, n in enumerate(counts):
            if n >= k:
                yield w.first + i, np.unique(value[cut[i]:cut[i + 1]])
            elif n:
                whole = np.array([n], np.uint64)
                for x in h[first[i]:first[i] + n]:
                    whole = mix(whole + np.uint64(x))
                yield w.first + i, whole
            else:
                yield w.first + i, np.zeros(0, np.uint64)


def _class(found: np.ndarray) -> int:
    """Signature of a set, as a signed long."""
    total = mix(found ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64) + np.uint64(len(found))
    return int(mix(np.array([total], np.uint64)).astype(np.int64)[0])


def _sizes(k: int):
    def run(batches):
        for batch in batches:
            n, of = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, found in _sets(batch, k):
                n[i], of[i] = len(found), _class(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(of)], ["doc_id", "n_shingles", "class"])

    return run


_PACKED = "bucket int, kind int, owners binary, sizes binary, lengths binary, tokens binary, marked binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in ("owners", "sizes", "lengths", "tokens", "marked")]])


def _row(bucket: int, kind: int, owners, sizes, lengths, tokens, marked=b"") -> pa.RecordBatch:
    raw = [x.tobytes() if isinstance(x, np.ndarray) else x for x in (owners, sizes, lengths, tokens, marked)]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), *[pa.array([x], pa.binary()) for x in raw]], schema=_SCHEMA)


def _pack(token: np.ndarray) -> bytes:
    """Sorted hashes as the first one and steps of six bytes; as they are where a step is too wide."""
    step = np.diff(token)
    if len(token) < 2 or int(step.max()) >> 48:
        return b"\0" + token.tobytes()
    return b"\1" + token[:1].tobytes() + np.ascontiguousarray(step).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    if raw[0] == 0:
        return np.frombuffer(raw, np.uint64, offset=1)
    step = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, 6)
    out = np.zeros((len(step) + 1, 8), np.uint8)
    out[1:, :6] = step
    out = out.reshape(-1).view(np.uint64)
    out[0] = np.frombuffer(raw, np.uint64, 1, offset=1)[0]
    return np.cumsum(out, dtype=np.uint64)


def _by_owner(owner: np.ndarray, size: np.ndarray, token: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (owner, size, token), packed by the owner's bucket."""
    if not len(owner):
        return
    bucket = ((mix(owner.view(np.uint64)) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.lexsort((owner, bucket))
    owner, size, token, bucket = owner[order], size[order], token[order], bucket[order]
    new = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    length = np.diff(np.append(new, len(owner)))
    for b in np.unique(bucket):
        lo, hi = np.searchsorted(bucket, [b, b + 1])
        i, j = np.searchsorted(new, [lo, hi])
        yield _row(int(b), 1, owner[new[i:j]], size[new[i:j]].astype(np.int32), length[i:j].astype(np.int32), token[lo:hi])


def _ask(k: int, buckets: int, held: int):
    """Map side: one entry for each shingle of what is held, and what is known to be shared already."""

    def flush(owners: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(s) for s in sets])
        owner = np.array(owners, np.int64)
        token = np.concatenate(sets)
        sets.clear()
        of = np.repeat(np.arange(len(size), dtype=np.uint32), size)
        order = np.argsort(token, kind="stable")
        token, of = token[order], of[order]
        del order
        new = np.append(True, token[1:] != token[:-1])
        many = np.diff(np.append(np.flatnonzero(new), len(token)))
        common = np.repeat(many > 1, many)
        del many
        yield from _by_owner(owner[of[common]], size[of[common]], token[common], buckets)
        marked = token[common & new]
        token, of = token[~common], of[~common]
        edge = lambda x: np.searchsorted(((x >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))
        at, mat = edge(token), edge(marked)
        for b in range(buckets):
            own, ref = np.unique(of[at[b]:at[b + 1]], return_inverse=True)
            if len(own) or mat[b] < mat[b + 1]:
                yield _row(b, 0, owner[own], size[own].astype(np.int32), ref.astype(np.uint16 if len(own) < 65536 else np.uint32),
                           _pack(token[at[b]:at[b + 1]]), marked[mat[b]:mat[b + 1]])

    def run(batches):
        owners, sets, total = [], [], 0
        seen: set[int] = set()
        for batch in batches:
            for _, found in _sets(batch, k):
                if not len(found) or (c := _class(found)) in seen:
                    continue
                seen.add(c)
                owners.append(c)
                sets.append(found)
                total += len(found)
                if total >= held:
                    yield from flush(owners, sets)
                    owners, sets, total = [], [], 0
                    seen = set()
        if sets:
            yield from flush(owners, sets)

    return run


def _values(batch: pa.RecordBatch, column: str, i: int) -> pa.Buffer:
    """The packed array of a row, not copied."""
    return batch.column(column)[i].as_buffer()


def _answer(buckets: int):
    """Reduce side: a shingle is shared if two sets have it; tells each set that asked. Only one bucket at a time is unpacked."""

    def shared_of(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owners, sizes, refs, tokens, marked, base = [], [], [], [], [], 0
        for own, size, ref, token, mark in rows:
            owners.append(np.frombuffer(own, np.int64))
            sizes.append(np.frombuffer(size, np.int32))
            refs.append(np.frombuffer(ref, np.uint16 if len(owners[-1]) < 65536 else np.uint32).astype(np.uint32) + np.uint32(base))
            tokens.append(_unpack(token))
            marked.append(np.frombuffer(mark, np.uint64))
            base += len(owners[-1])
        owner, size, ref, token = map(np.concatenate, (owners, sizes, refs, tokens))
        del refs, tokens
        order = np.argsort(token, kind="stable")
        token, ref = token[order], ref[order]
        mark = np.unique(np.concatenate(marked))
        new = np.append(True, token[1:] != token[:-1])[:len(token)]
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(token)))
        lowest = owner[ref]
        differs = (np.maximum.reduceat(lowest, first) != np.minimum.reduceat(lowest, first)) if len(first) else np.zeros(0, bool)
        known = np.zeros(len(first), bool)
        if len(mark) and len(first):
            at = np.minimum(np.searchsorted(mark, token[first]), len(mark) - 1)
            known = mark[at] == token[first]
        shared = np.repeat(differs | known, many)
        return owner[ref[shared]], size[ref[shared]], token[shared]

    def run(batches):
        asked: dict[int, list[tuple]] = {}
        for batch in batches:
            known = pc.equal(batch.column("kind"), 1)
            if pc.any(known).as_py():
                yield batch.filter(known)
            batch = batch.filter(pc.invert(known))
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                asked.setdefault(bucket, []).append(tuple(_values(batch, c, i) for c in ("owners", "sizes", "lengths", "tokens", "marked")))
        found, total = [], 0
        for bucket in sorted(asked):
            found.append(shared_of(asked.pop(bucket)))
            total += len(found[-1][0])
            if total > MOST or not asked:
                yield from _by_owner(*(np.concatenate([x[i] for x in found]) for i in range(3)), buckets)
                found, total = [], 0

    return run


def _gather(percent: int):
    """Shared shingles of each set, for sets that share enough of them. A bucket has all that is told to its sets."""

    def fold(parts: list[tuple]) -> list[tuple]:
        owner, size, token = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((token, owner))
        owner, size, token = owner[order], size[order], token[order]
        keep = np.append(True, (owner[1:] != owner[:-1]) | (token[1:] != token[:-1]))[:len(owner)]
        return [(owner[keep], size[keep], token[keep])]

    def sets(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        owner, size, token = fold(parts)[0]
        new = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[:len(owner)])
        many = np.diff(np.append(new, len(owner)))
        n = size[new].astype(np.int64)
        for i in np.flatnonzero(100 * many >= percent * n):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(owner[new[i]])], pa.int64()), pa.array([int(n[i])], pa.int64()),
                 pa.array([token[new[i]:new[i] + many[i]].view(np.int64)], pa.list_(pa.int64()))], ["id", "n", "s"])

    def run(batches):
        parts: dict[int, list[tuple]] = {}
        total, folded = 0, 0
        for batch in batches:
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                length = np.frombuffer(_values(batch, "lengths", i), np.int32)
                # copies: a part must not keep its batch alive
                parts.setdefault(bucket, []).append((np.repeat(np.frombuffer(_values(batch, "owners", i), np.int64), length),
                                                     np.repeat(np.frombuffer(_values(batch, "sizes", i), np.int32), length),
                                                     np.frombuffer(_values(batch, "tokens", i), np.uint64).copy()))
                total += len(parts[bucket][-1][0])
                if total > MOST + 2 * folded:
                    for b in parts:
                        parts[b] = fold(parts[b])
                    total = folded = sum(len(p[0][0]) for p in parts.values())
        for bucket in sorted(parts):
            yield from sets(parts.pop(bucket))

    def packed(batches):
        """Rows of many sets in one batch."""
        held = []
        for b in run(batches):
            held.append(b)
            if len(held) == 500:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return packed


def shared_sets(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n, s): distinct sets that share at least ``percent`` of their n shingles with other sets, and which ones."""
    parts = partitions(docs.sparkSession)
    buckets = 4 * parts
    # by number: each task gets four buckets, where by hash some would get ten or more
    asked = docs.select("text").mapInArrow(_ask(k, buckets, HELD), _PACKED)
    told = asked.repartitionById(parts, F.expr(f"bucket % {parts}")).mapInArrow(_answer(buckets), _PACKED)
    return told.repartitionById(parts, F.expr(f"bucket % {parts}")).mapInArrow(_gather(percent), "id long, n long, s array<long>")


_COUNTS = "bucket int, scope long, tokens binary, counts binary"


def _count(buckets: int):
    """Of one scope: its shingles with the number of its sets that have them."""

    def run(part: pa.Table) -> pa.Table:
        token, many = np.unique(part["s"].combine_chunks().flatten().to_numpy().view(np.uint64), return_counts=True)
        at = np.searchsorted(((token >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))
        full = [b for b in range(buckets) if at[b] < at[b + 1]]
        return pa.table({"bucket": pa.array(full, pa.int32()), "scope": pa.array([part["scope"][0].as_py()] * len(full), pa.int64()),
                         "tokens": pa.array([_pack(token[at[b]:at[b + 1]]) for b in full], pa.binary()),
                         "counts": pa.array([many[at[b]:at[b + 1]].astype(np.int64).tobytes() for b in full], pa.binary())})

    return run


def _total(batches):
    """Number of sets that have a shingle, told to each scope that has it."""
    rows = [row for batch in batches for row in batch.to_pylist()]
    if not rows:
        return
    tokens = [_unpack(r["tokens"]) for r in rows]
    token, of = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.zeros(len(token), np.int64)
    np.add.at(total, of, np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows]))
    at = np.cumsum([0, *map(len, tokens)])
    for i, r in enumerate(rows):
        yield pa.RecordBatch.from_arrays([pa.array([r["scope"]], pa.int64()), pa.array([r["tokens"]], pa.binary()),
                                          pa.array([total[of[at[i]:at[i + 1]]].tobytes()], pa.binary())], ["scope", "tokens", "counts"])


def _rank(percent: int):
    """Sets of one scope without shingles that only dropped sets share, the rarest first."""

    def run(part: pa.Table, told: pa.Table) -> pa.Table:
        known = np.concatenate([_unpack(t) for t in told["tokens"].to_pylist()] or [np.zeros(0, np.uint64)])
        total = np.concatenate([np.frombuffer(c, np.int64) for c in told["counts"].to_pylist()] or [np.zeros(0, np.int64)])
        order = np.argsort(known)
        known, total = known[order], total[order]
        ids, sizes, sets = [], [], []
        for i, n, s in zip(part["id"].to_pylist(), part["n"].to_pylist(), part["s"].combine_chunks()):
            s = s.values.to_numpy().view(np.uint64)
            many = total[np.searchsorted(known, s)]
            s, many = s[many > 1], many[many > 1]
            if 100 * len(s) >= percent * n:
                ids.append(i)
                sizes.append(n)
                sets.append(s[np.lexsort((s, many))].view(np.int64))
        return pa.table({"id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()), "s": pa.array(sets, pa.list_(pa.int64()))})

    return run


def ranked(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The sets with their shingles ordered by the number of sets that have them: the order of all prefixes.

    Shingles that only sets without partners share are dropped, and so are sets that then share too few.
    """
    parts = partitions(sets.sparkSession)
    held = sets.agg(F.coalesce(F.sum(F.size("s")), F.lit(0)).alias("n")).first()["n"]
    own = sets.withColumn("scope", F.pmod("id", F.lit(held // HELD * 2 + parts)))
    told = (own.groupBy("scope").applyInArrow(_count(parts), _COUNTS).repartitionById(parts, "bucket")
            .mapInArrow(_total, "scope long, tokens binary, counts binary"))
    return own.groupBy("scope").cogroup(told.groupBy("scope")).applyInArrow(_rank(percent), "id long, n long, s array<long>")


def _need(percent: int) -> F.Column:
    return F.expr(f"(n * {percent} + 99) DIV 100")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(right, "b").join(left, "a").withColumn("both", both)
            .where(F.col("both") * 100 >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"))


def signatures(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, id, n, alone, rest): what partners agree on, by subsets for light sets and by inverted lists for heavy ones.

    ``alone`` is the number of shingles that no other set has. ``rest`` bounds the overlap of partners whose first common
    key this is: shingles from there on in the prefix order.
    """
    sets = sets.withColumn("own", F.size("s") - _need(percent)).withColumn("alone", F.col("n") - F.size("s"))
    lists = sets.select("id", "n", "alone", F.size("s").alias("k"), F.posexplode(F.slice("s", 1, F.col("own").cast("int") + 1)).alias("i", "key"))
    by = F.ceil(F.log2(F.col("n").cast("double"))).cast("int")
    counts = lists.groupBy("key", by.alias("scale")).count()
    # a list entry is compared with the list's hub, and in further rounds if that leaves it apart
    read = (counts.withColumn("length", F.sum("count").over(Window.partitionBy("key")))
            .groupBy("scale").agg(F.sum(F.col("count") * F.log2(F.col("length") + 1)).alias("read")))
    made = sets.where("n > 1").groupBy(by.alias("scale")).agg(F.sum((F.col("own") + 2) * (F.col("own") + 1) / 2).alias("made"))
    costs = {r["scale"]: (r["read"] or 0, r["made"] or 0) for r in read.join(made, "scale", "full").collect()}
    bound = min([-1, *costs], key=lambda x: (sum(m for s, (_, m) in costs.items() if s <= x) + sum(r for s, (r, _) in costs.items() if s > x), x))
    light = 2 ** bound if bound >= 0 else 0
    plain = ["id", "n", "alone"]
    heavy = (lists.where(F.lit(100) * F.col("n") > F.lit(percent * light))
             .select(F.xxhash64("key").alias("key"), *plain, (F.col("k") - F.col("i")).cast("int").alias("rest")))
    subsets = (sets.where((F.col("n") > 1) & (F.col("n") <= light))
               .select(*plain, F.size("s").alias("k"), F.slice("s", 1, F.col("own").cast("int") + 2).alias("p"))
               .select(*plain, "k", "p", F.posexplode("p").alias("i", "x"))
               .select(*plain, "x", (F.col("k") - F.col("i")).alias("rest"), F.explode(F.expr("slice(p, i + 2, size(p))")).alias("y"))
               .select(F.xxhash64("x", "y").alias("key"), *plain, F.col("rest").cast("int").alias("rest")))
    return heavy.unionByName(subsets)


def _fit(a: str, b: str, percent: int) -> F.Column:
    """Sizes and positions that allow the similarity."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return ((F.lit(percent) * na <= 100 * nb) & (F.lit(percent) * nb <= 100 * na)
            & (F.lit(100 + percent) * F.least(f"{a}.rest", f"{b}.rest") >= F.lit(percent) * (na + nb)))


def class_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, root) for sets with links: the smallest id of their component."""
    sets = materialise(ranked(materialise(sets, "sets"), percent), "ranked")
    keys = materialise(signatures(sets, percent), "signatures")
    # the hub of a list is the set with the least of its own: what others were copied from, if there is such a set
    hub = keys.groupBy("key").agg(F.min(F.struct("alone", "id", "n", "rest")).alias("a"), F.count("*").alias("many")).where("many > 1")
    pairs = (keys.select("key", F.struct("id", "n", "rest").alias("b")).join(hub, "key")
             .where((F.col("a.id") != F.col("b.id")) & _fit("a", "b", percent))
             .select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())
    links = materialise(_verified(pairs, sets, percent), "verified")
    roots = components(links)
    # what one comparison for each list left apart
    own = keys.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")).select("key", F.struct("id", "n", "rest", "root").alias("a"))
    own = materialise(own, "rooted")
    apart = own.groupBy("key").agg((F.min("a.root") != F.max("a.root")).alias("apart")).where("apart").select("key")
    own = own.join(apart, "key", "left_semi")
    rest = (own.join(own.select("key", F.col("a").alias("b")), "key").where((F.col("a.root") < F.col("b.root")) & _fit("a", "b", percent))
            .select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())
    more = materialise(_verified(rest, sets, percent), "verified")
    if more.isEmpty():
        return roots
    return components(links.unionByName(more))


def _tag(k: int):
    def run(batches):
        for batch in batches:
            of = [None] * batch.num_rows
            for i, found in _sets(batch, k):
                of[i] = _class(found) if len(found) else None
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of, pa.int64())], [*batch.schema.names, "__class"])

    return run


def tagged(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """``docs`` with ``__class``, the signature of each row's set (null for an empty set), as ``joined`` has it."""
    return docs.mapInArrow(_tag(k), T.StructType([*docs.schema.fields, T.StructField("__class", T.LongType())]))


def joined(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each document: doc_id, n_shingles, class (signature of its set), root (a class, one for each component) and
    component_id.

    Sets are taken from the lower-cased (A-Z) words of ``text``. A document without words or with a null text has an empty
    set and is linked with nothing; one of fewer than ``k`` words has its whole sequence as the one shingle. Equal sets are linked.
    A row without a doc_id takes part and gets the smallest id of its component, if any. Repeated rows get a row each; other
    columns are ignored; an empty table gives an empty result.
    """
    rows = materialise(docs.select("doc_id", "text").mapInArrow(_sizes(k), "doc_id long, n_shingles long, class long"), "sizes")
    roots = class_links(shared_sets(docs, k, percent), percent)
    filled = (rows.where("n_shingles > 0").join(roots.withColumnRenamed("id", "class"), "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    least = filled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (filled.join(least, "root").select("doc_id", "n_shingles", "class", "root", "component_id")
            .unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("class"),
                                                             F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))))


SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
kinds AS (SELECT min(doc_id) AS id, list_sort(s) AS s, len(s) AS n FROM sets GROUP BY list_sort(s), len(s)),
flat AS (SELECT id, n, unnest(s) AS g FROM kinds),
rare AS (SELECT g FROM flat GROUP BY g HAVING count(*) > 1),
kept AS (SELECT id, n, g FROM flat SEMI JOIN rare USING (g)),
links AS (
  SELECT a.id AS a, b.id AS b FROM kept a JOIN kept b ON a.g = b.g AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT id, id FROM kinds UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT a, min(b) AS root FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE root END AS component_id
FROM sets s JOIN kinds k ON k.s = list_sort(s.s) JOIN reach ON reach.a = k.id"""


@query("op3_ngram_join", SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return joined(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
