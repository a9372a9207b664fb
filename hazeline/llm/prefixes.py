"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is laid out in blocks of ``WIDTH`` positional columns of turn ids. One ``ROLLUP`` over the columns of a block
aggregates the prefixes of all depths together, and ``grouping_id`` tells the depth. A later block continues the
prefix of the blocks before it, whose node is part of its grouping key: nodes are named by the XOR of position-bound hashes of
their turns, so a row of any block knows its prior node without waiting for the block before it, and blocks of
all depths go through the same aggregation.

Sums over subtrees need no walk either. The members of a node are the conversations through it, so what every conversation
brings (whether it stands for a leaf, and the tokens that its own nodes save) is summed by the same ROLLUP. A node is
owned by its smallest member, whose nodes from some depth on are all its own; what those above the node save is taken off again.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from hazeline.llm.base import WORD, query, table, word_count
from hazeline.session import materialise

#: Positional columns of a block.
WIDTH = 8
#: Blocks, or nodes of a path, that one window sees.
CHUNK = 4096
#: Conversation ids whose list is made in one group.
IDS = 4096
_KEY = ["k1", "k2"]
_SLOTS = [f"t{i}" for i in range(1, WIDTH + 1)]


def _mark(place, turn) -> list:
    """Both halves of a turn's part in the name of the nodes that it leads to."""
    return [F.xxhash64(F.lit(i), place.cast("long"), turn) for i in (1, 2)]


def _name(level) -> list:
    """Name of the node that the first ``level`` turns of a block lead to."""
    out = [F.col(k) for k in _KEY]
    for n, t in enumerate(_SLOTS, 1):
        marks = _mark(F.col("block") * WIDTH + n, F.col(t))
        out = [k.bitwiseXOR(F.when(level >= n, m).otherwise(F.lit(0))) for k, m in zip(out, marks)]
    return out


def _before(df: DataFrame, key: str, place: str, sums: dict) -> DataFrame:
    """Add columns that aggregate ``sums`` (name -> column function, column) over rows of ``key`` with a smaller ``place``.

    A long key is cut into chunks of places; totals of chunks are carried, so no window sees all of its rows. Nothing before
    gives null.
    """
    df = df.withColumn("__chunk", F.floor(F.col(place) / CHUNK))
    totals = df.groupBy(key, "__chunk").agg(*[f(c).alias(f"__{n}") for n, (f, c) in sums.items()])
    prior = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col(key).alias("__key"), F.col("__chunk").alias("__at"),
                          *[f(f"__{n}").over(prior).alias(f"__{n}") for n, (f, _) in sums.items()])
    inside = Window.partitionBy(key, "__chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumns({f"__in_{n}": f(c).over(inside) for n, (f, c) in sums.items()})
    out = out.join(carry, (F.col(key) == F.col("__key")) & (F.col("__chunk") == F.col("__at")), "left")
    both = {n: F.coalesce(F.col(f"__{n}").bitwiseXOR(F.col(f"__in_{n}")) if f is F.bit_xor else F.col(f"__{n}") + F.col(f"__in_{n}"),
                          F.col(f"__{n}"), F.col(f"__in_{n}")) for n, (f, _) in sums.items()}
    return out.withColumns(both).drop("__chunk", "__key", "__at", *[f"__{n}" for n in sums], *[f"__in_{n}" for n in sums])


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, turn): turns of a conversation numbered from 1, by turn (null first), then by name.

    ``turn`` is the turn's name, a hash of role and text, and the number of words of the text, so texts are read once and
    never shuffled. Rows are dealt by range: a conversation that is longer than a partition is numbered in parts that
    start at the counts of the parts before.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)), F.lit(":"),
                    word_count(text).cast("string"))
    order = [F.col("place").asc_nulls_first(), F.col("turn")]
    own = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("place"),
                                                   name.alias("turn"))
    own = materialise(own, "names").repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    own = materialise(own.withColumn("n", inside).select("conv_id", "part", "n", "turn"), "turns")
    prior = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.groupBy("conv_id", "part").agg(F.count("*").alias("c")).select(
        "conv_id", "part", F.coalesce(F.sum("c").over(prior), F.lit(0)).alias("start"))
    return own.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("start") + F.col("n")).alias("pos"), "turn")


def rebuilt(turns: DataFrame, step: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with turns of another one: (conv_id, n_turns), and their turns (conv_id, pos, turn).

    Conversation c starts with the first h turns of c - c % ``step`` (all if it has fewer, none if there is none), where h is
    crc32 of its decimal id modulo ``heads``, and goes on with its own turns after its first h.
    """
    counts = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    base = F.col("conv_id") - F.col("conv_id") % step
    convs = counts.select("conv_id", "own", head.alias("h"), base.alias("base"))
    lead = counts.select(F.col("conv_id").alias("base"), F.col("own").alias("others"))
    convs = materialise(convs.join(lead, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("others", F.lit(0))).alias("taken"),
        F.greatest(F.col("own") - F.col("h"), F.lit(0)).alias("rest")), "conversations")
    # a conversation lends at most heads - 1 turns, to at most `step` others
    lent = turns.where(F.col("pos") < heads).withColumnRenamed("conv_id", "base")
    first = lent.join(convs.select("conv_id", "base", "h"), "base").where("pos <= h").select("conv_id", "pos", "turn")
    shift = convs.select("conv_id", "h", "taken")
    after = turns.join(shift, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn")
    return convs.select("conv_id", (F.col("taken") + F.col("rest")).alias("n_turns")), first.unionByName(after)


def laid_out(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row a conversation and block: conv_id, block, the prior node (k1, k2), and turns t1, t2, .. (null after the end).

    Block 0 is there for a conversation without turns, too.
    """
    marks = _mark(F.col("pos"), F.col("turn"))
    slot = (F.col("pos") - 1) % WIDTH
    blocks = turns.withColumn("block", F.floor((F.col("pos") - 1) / WIDTH)).groupBy("conv_id", "block").agg(
        *[F.max(F.when(slot == i, F.col("turn"))).alias(t) for i, t in enumerate(_SLOTS)],
        *[F.bit_xor(m).alias(f"x{i}") for i, m in enumerate(marks, 1)])
    blocks = _before(blocks, "conv_id", "block", {k: (F.bit_xor, f"x{i}") for i, k in enumerate(_KEY, 1)})
    bare = convs.where("n_turns = 0").select("conv_id", F.lit(0).cast("long").alias("block"))
    out = blocks.select("conv_id", "block", *_KEY, *_SLOTS).unionByName(bare, allowMissingColumns=True)
    return out.withColumns({k: F.coalesce(k, F.lit(0)) for k in _KEY})


def rolled(blocks: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """One row a node: ``depth``, its name (k1, k2), its parent's (p1, p2), its last turn, and SQL ``aggregates`` of its members.

    ``blocks`` is what ``laid_out`` gives, with the columns that the aggregates read.
    """
    slots, keys = ", ".join(_SLOTS), ", ".join(_KEY)
    wanted = ", ".join(f"{a} AS {n}" for n, a in aggregates.items())
    out = blocks.sparkSession.sql(f"""SELECT block, {keys}, {slots}, {WIDTH} - bit_count(grouping_id()) AS level, {wanted}
        FROM {{rows}} GROUP BY block, {keys}, ROLLUP({slots})""", rows=blocks)
    last = F.element_at(F.array(*_SLOTS), F.greatest(F.col("level"), F.lit(1)).cast("int"))
    # level 0 is the prior block's node, but for the root; a group that ends in a missing turn is no node
    out = out.withColumn("last", F.when(F.col("level") > 0, last)).where(
        ((F.col("level") == 0) & (F.col("block") == 0)) | F.col("last").isNotNull())
    own, up = _name(F.col("level")), _name(F.col("level") - 1)
    return out.select((F.col("block") * WIDTH + F.col("level")).alias("depth"), *[c.alias(k) for c, k in zip(own, _KEY)],
                      *[c.alias(p) for c, p in zip(up, ("p1", "p2"))], "last", *aggregates)


def _hashed(batches):
    """Running SHA-256 of sorted (k1, k2, depth, ids) rows, one digest for each node."""
    now, state, n = None, None, 0
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

    def out(keys, digest):
        return pa.RecordBatch.from_pydict({"k1": [keys[0]], "k2": [keys[1]], "depth": [keys[2]], "ends_sha256": [digest]}, schema=schema)

    for b in batches:
        done = {c: [] for c in schema.names}
        for k1, k2, d, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "depth", "ids"))):
            if (k1, k2, d) != now:
                if now is not None:
                    for c, v in zip(schema.names, (*now, state.hexdigest())):
                        done[c].append(v)
                now, state = (k1, k2, d), hashlib.sha256()
                state.update(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done["k1"]:
            yield pa.RecordBatch.from_pydict(done, schema=schema)
    if now is not None:
        yield out(now, state.hexdigest())


def ends(names: DataFrame) -> DataFrame:
    """Digest of the ids that end at a node, for nodes at which conversations end.

    Ids come in lists of at most ``IDS``, made in parallel; the lists of a node are hashed one after the other in the order
    of their ids, so that a node with many equal conversations needs no memory for them.
    """
    chunk = F.floor(F.col("conv_id") / IDS)
    lists = names.withColumn("chunk", chunk).groupBy("k1", "k2", "depth", "chunk").agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    lists = lists.repartition("k1", "k2", "depth").sortWithinPartitions("k1", "k2", "depth", "chunk")
    return lists.select("k1", "k2", "depth", "ids").mapInArrow(_hashed, "k1 long, k2 long, depth long, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each distinct prefix of conversations, from the empty one.

    ``convs`` has conv_id and n_turns, ``turns`` conv_id, pos (1 to n_turns) and turn (``name:words``). Columns: conv_id
    (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and
    last (the last turn). No conversations give no rows, not even a root.
    """
    blocks = materialise(laid_out(convs, turns), "blocks")
    words = F.coalesce(F.split_part("last", F.lit(":"), F.lit(2)).cast("long"), F.lit(0))
    nodes = rolled(blocks, {"conv_id": "min(conv_id)", "n_convs": "count(*)"})
    nodes = materialise(nodes.withColumn("value", (F.col("n_convs") - 1) * words), "nodes")

    at = ["k1", "k2", "depth"]
    whole = blocks.groupBy("conv_id").agg(F.max("block").alias("block"))
    slots = F.array_size(F.array_compact(F.array(*_SLOTS)))
    stop = blocks.join(whole, ["conv_id", "block"]).withColumn("level", slots)
    stop = materialise(stop.select("conv_id", (F.col("block") * WIDTH + F.col("level")).alias("depth"),
                                   *[c.alias(k) for c, k in zip(_name(F.col("level")), _KEY)]), "ends")
    counted = stop.groupBy(*at).agg(F.count("*").alias("n_ends"))
    nodes = nodes.join(counted, at, "left").withColumn("leaf", F.coalesce(F.col("n_ends") == F.col("n_convs"), F.lit(False)).cast("int"))

    # what a conversation's own nodes bring, summed over the members of each node
    owners = nodes.groupBy("conv_id").agg(F.sum("value").alias("saves"), F.max("leaf").alias("leaf")).where("saves > 0 OR leaf > 0")
    sums = rolled(blocks.join(owners, "conv_id"), {"n_leaves": "sum(leaf)", "saved": "sum(saves)"}).drop("p1", "p2", "last")
    paths = _before(nodes, "conv_id", "depth", {"above": (F.sum, "value")})
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    full = (paths.join(sums, at, "left").join(children, at, "left").join(ends(stop), at, "left"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"),
                           F.col("conv_id").alias("parent_conv_id"))
    full = full.join(parents, ["p1", "p2", "depth"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", zero("n_children").alias("n_children"),
                       zero("n_leaves").alias("n_leaves"), (zero("saved") - zero("above")).alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "last")


def prefix_trie(rows: DataFrame, step: int = 20, heads: int = 4) -> DataFrame:
    """Trie of rebuilt conversations; ``rows`` has conv_id, turn, role and text, other columns are ignored.

    Rows without a conv_id belong to no conversation and take no part. Null roles and texts count as empty. Turns with equal
    numbers are ordered by the hash of role and text; repeated rows are turns of their own. An empty table gives an
    empty result; a very long text is read once, for its hash. Two different turns or prefixes are taken for equal with a
    chance of 2^-128 for each pair compared.
    """
    turns = materialise(numbered_turns(rows), "numbered")
    return trie(*rebuilt(turns, step, heads))


# crc32 of the decimal id, bit by bit: a byte is joined at the first of its eight steps
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda acc, b: xor(xor(acc, b) >> 1, CASE WHEN xor(acc, b) & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)), 4294967295::BIGINT)"""

_SQL = f"""WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY pos) AS l FROM own GROUP BY conv_id),
heads AS (SELECT conv_id, l, {_CRC} % 4 AS h FROM turns),
convs AS (SELECT a.conv_id, list_concat(coalesce(list_slice(b.l, 1, a.h), []), list_slice(a.l, a.h + 1, len(a.l))) AS l
  FROM heads a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 20),
prefixes AS (SELECT conv_id, len(l) AS n, d AS depth, list_slice(l, 1, d) AS p FROM (SELECT conv_id, l, unnest(range(len(l) + 1)) AS d FROM convs)),
nodes AS (SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256,
  (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(p[depth].t, '{WORD}')) END AS value
  FROM prefixes GROUP BY p, depth),
families AS (SELECT list_slice(p, 1, depth - 1) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
trees AS (SELECT a.p, sum(d.value) AS saved, sum(CASE WHEN f.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM nodes d LEFT JOIN families f ON f.p = d.p JOIN nodes a ON a.depth <= d.depth AND list_slice(d.p, 1, a.depth) = a.p GROUP BY a.p)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, a.n_convs, coalesce(f.n, 0) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, a.ends_sha256
FROM nodes a JOIN trees s ON s.p = a.p LEFT JOIN families f ON f.p = a.p
LEFT JOIN nodes u ON a.depth > 0 AND u.depth = a.depth - 1 AND u.p = list_slice(a.p, 1, a.depth - 1)"""


@query("op13_prefix_trie", _SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations")).drop("last")
