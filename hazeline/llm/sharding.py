"""Sharding by balanced label propagation.

Documents that share a link key (an equal text, say) are linked. Labels are shards. In each round, linked documents want
to move to the shard where most of their neighbours are; a shard accepts moves, the largest gain first, as long as its
quota of documents allows. Documents without links are free: they fill what is left, so all shards end up at most one
document apart. State is one row for each (link key, first shard), with the number of documents in it, so a round joins
and aggregates that table and never the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.llm.base import numbered, query, table
from hazeline.session import materialise

SHARDS = 8
#: Rounds at most; ``settle`` places what they leave. In every other round the dice alone decide, so that large groups which
#: don't fit hold up nobody for long.
ROUNDS = 8
#: A link group is handled in parts of at most this share of a shard, as a group of a third of all rows fits into no shard.
PART = 0.25
#: Gain classes times dice classes of the quota table: what the driver sees of a round, whatever the input.
GAINS, DICE = 16, 64


def _gain_class(gain) -> F.Column:
    """0 for the largest gains: by powers of two."""
    return F.lit(GAINS - 1) - F.least(F.lit(GAINS - 1), F.floor(F.log2(F.greatest(gain, F.lit(1)).cast("double"))).cast("int"))


def _accepted(cells: list, held: list[int], quota: list[int]) -> set:
    """Of all wanted moves (gain, dice, goal, change of each shard), best first, those that leave no shard beyond its quota.

    All moves count at once, so what leaves a shard in a round makes room in it. While a shard is too full, its last move is
    taken back; then moves that fit after all are taken in again. A shard that is too full already may stay so.
    """
    most = [max(q, h) for q, h in zip(quota, held)]
    now = [h + sum(c[3][b] for c in cells) for b, h in enumerate(held)]
    taken = set(range(len(cells)))
    into = [[i for i, c in enumerate(cells) if c[2] == b] for b in range(len(quota))]
    while any(x > m for x, m in zip(now, most)):
        b = max((b for b in range(len(quota)) if into[b]), key=lambda b: now[b] - most[b])
        i = into[b].pop()
        taken.discard(i)
        now = [x - y for x, y in zip(now, cells[i][3])]
    for i in sorted(set(range(len(cells))) - taken):
        after = [x + y for x, y in zip(now, cells[i][3])]
        if all(x <= m for x, m in zip(after, most)):
            now = after
            taken.add(i)
    return {cells[i][:3] for i in taken}


def _keys(state: DataFrame, shards: int) -> DataFrame:
    """One row for each key: size, places, n0, n1, .. (documents in each shard)."""
    return state.groupBy("key").agg(
        F.count_distinct("shard").alias("places"), F.sum("n").alias("size"), F.min("shard").alias("at"),
        *[F.sum(F.when(F.col("shard") == b, F.col("n")).otherwise(0)).alias(f"n{b}") for b in range(shards)])


def propagate(state: DataFrame, quota: list[int], rounds: int = ROUNDS, fixed: list[str] = ()) -> DataFrame:
    """Move the members of link keys between shards under quotas, until all keys that fit are whole.

    ``state``: key, start (first shard), n (documents), shard (present one; the number of shards stands for none). Rounds of
    moves end when neither kind of round has a move that is accepted; keys that are cut then, or after ``rounds``, are
    placed by ``settle``. Keys of ``fixed``, a few, are whole and stay where they are.
    """
    shards, idle = len(quota), 0
    for turn in range(rounds):
        keys = _keys(state, shards)
        sums = keys.agg(*[F.coalesce(F.sum(f"n{b}"), F.lit(0)).alias(f"h{b}") for b in range(shards)],
                        *[F.coalesce(F.sum(F.when(F.col("places") == 1, F.col(f"n{b}"))), F.lit(0)).alias(f"w{b}")
                          for b in range(shards)]).first()
        held, room = [sums[f"h{b}"] for b in range(shards)], [quota[b] - sums[f"w{b}"] for b in range(shards)]
        # the shard with the most members; one that whole keys fill up is no goal
        goal = F.greatest(*[F.when((F.col(f"n{b}") > 0) & F.lit(room[b] > 0),
                                   F.struct(F.col(f"n{b}").alias("n"), F.xxhash64("key", F.lit(b), F.lit(turn)).alias("dice"),
                                            F.lit(b).alias("shard"))) for b in range(shards)])
        change = [(F.when(F.col("goal") == b, F.col("size")).otherwise(0) - F.col(f"n{b}")).alias(f"d{b}") for b in range(shards)]
        wants = materialise(
            keys.where("places > 1").withColumn("best", goal).where("best IS NOT NULL")
            .withColumn("goal", F.col("best")["shard"])
            .select("key", "goal", (_gain_class(F.col("best")["n"]) if turn % 2 == 0 else F.lit(0)).alias("gain"),
                    F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(DICE)).cast("int").alias("dice"), *change), "wants")
        sums = wants.groupBy("gain", "dice", "goal").agg(*[F.sum(f"d{b}").alias(f"d{b}") for b in range(shards)]).collect()
        cells = sorted((r["gain"], r["dice"], r["goal"], [r[f"d{b}"] for b in range(shards)]) for r in sums)
        if not cells:
            break
        taken = _accepted(cells, held, quota)
        idle = 0 if taken else idle + 1
        if idle == 2:
            break
        if not taken:
            continue
        code = lambda g, d, b: (g * DICE + d) * shards + b
        moves = wants.where(code(F.col("gain"), F.col("dice"), F.col("goal")).isin([code(*c) for c in sorted(taken)])).select(
            F.col("key").alias("__key"), "goal")
        state = materialise(state.join(moves, F.col("key") == F.col("__key"), "left")
                            .withColumn("shard", F.coalesce("goal", "shard")).drop("__key", "goal"), "labels")
    return settle(state, quota, fixed)


def settle(state: DataFrame, quota: list[int], fixed: list[str] = (), per_block: int = 100_000) -> DataFrame:
    """Place the keys that are cut still, whole, into what whole keys leave of the quotas.

    The keys are laid end to end along the room of all shards. A key within one shard's stretch is placed there. One on a
    border (at most one for each shard) goes to the smallest room left that holds it; if none does, it gets no shard, and its
    documents fill up like free ones. Whole keys of a shard beyond its quota are laid anew, but for ``fixed``.
    """
    shards = len(quota)
    keys = materialise(_keys(state, shards).select("key", "size", "places", "at"), "keys")
    stays = F.col("key").isin(list(fixed)) if fixed else F.lit(False)
    whole = {(r["at"], r["stays"]): r["n"] for r in keys.where("places = 1").groupBy("at", stays.alias("stays")).agg(F.sum("size").alias("n")).collect()}
    own, other = [whole.get((b, True), 0) for b in range(shards)], [whole.get((b, False), 0) for b in range(shards)]
    over = [b for b in range(shards) if own[b] + other[b] > quota[b]]
    room = [max(0, quota[b] - own[b] - (0 if b in over else other[b])) for b in range(shards)]
    todo = keys.where((F.col("places") > 1) | F.col("at").isin(over) & ~stays if over else F.col("places") > 1).select("key", "size")
    count = todo.count()
    if not count:
        return state
    todo = todo.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(count // per_block + 1)))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    starts = (todo.groupBy("block").agg(F.sum("size").alias("n"))
              .select(F.col("block").alias("__b"), F.coalesce(F.sum("n").over(before(Window.orderBy("block"))), F.lit(0)).alias("__start")))
    inside = F.coalesce(F.sum("size").over(before(Window.partitionBy("block").orderBy("key"))), F.lit(0))
    begin = F.col("__start") + F.col("__in")
    place, low = F.lit(None).cast("int"), 0
    for b in range(shards):
        place = F.when((begin >= low) & (begin + F.col("size") <= low + room[b]), b).otherwise(place)
        low += room[b]
    laid = materialise(todo.withColumn("__in", inside).join(starts, F.col("block") == F.col("__b"))
                       .select("key", "size", place.alias("goal")), "laid")
    for r in laid.where("goal IS NOT NULL").groupBy("goal").agg(F.sum("size").alias("n")).collect():
        room[r["goal"]] -= r["n"]
    border = _fit([(r["key"], r["size"]) for r in laid.where("goal IS NULL").orderBy(F.desc("size"), "key").collect()], room)
    laid = laid.select(F.col("key").alias("__key"), F.coalesce("goal", _lookup("key", border)).alias("goal"))
    return materialise(state.join(laid, F.col("key") == F.col("__key"), "left")
                       .withColumn("shard", F.coalesce("goal", "shard")).drop("__key", "goal"), "labels")


def _fit(sizes: list[tuple[str, int]], room: list[int]) -> dict[str, int]:
    """Shard of each key: the one with the least room that holds it, or none (the number of shards). ``room`` shrinks."""
    out = {}
    for key, size in sizes:
        b = min((b for b in range(len(room)) if room[b] >= size), key=lambda b: (room[b], b), default=len(room))
        out[key] = b
        if b < len(room):
            room[b] -= size
    return out


def _lookup(column: str, values: dict[str, int]) -> F.Column:
    if not values:
        return F.lit(None).cast("int")
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col(column)]


def _large(parts: list, quota: list[int]) -> dict[str, int]:
    """Shards of the parts (link, key, n) of groups too large to be one key, the largest group first.

    A group goes as a whole to the smallest room that holds it. One that fits nowhere fills the largest room, part by part,
    then the next largest.
    """
    room, groups = list(quota), {}
    for link, key, n in sorted(parts):
        groups.setdefault(link, []).append((key, n))
    out = {}
    for link, own in sorted(groups.items(), key=lambda g: (-sum(n for _, n in g[1]), g[0])):
        [b] = _fit([(link, sum(n for _, n in own))], room).values()
        if b < len(quota):
            out.update({key: b for key, _ in own})
            continue
        left = sorted(own, key=lambda p: (-p[1], p[0]))
        for b in sorted(range(len(quota)), key=lambda b: (-room[b], b)):
            for p in list(left):
                if p[1] <= room[b]:
                    out[p[0]] = b
                    room[b] -= p[1]
                    left.remove(p)
        out.update({key: len(quota) for key, _ in left})
    return out


def assign(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Add shard, slot and linked to ``rows`` (row: unique long, link: key or null, and other columns).

    Shards differ by one row at most, the first ones being the larger; slots count from 0 in each shard. A row whose link
    key nobody shares is free. An empty table gives an empty result.
    """
    total = rows.count()
    quota = [total // shards + (b < total % shards) for b in range(shards)]
    groups = (rows.where(F.col("link").isNotNull()).groupBy("link").agg(F.count("*").alias("members")).where("members > 1")
              .withColumnRenamed("link", "__link"))
    part = max(1, int(PART * total / shards))
    rows = materialise(
        rows.join(groups, F.col("link") == F.col("__link"), "left").drop("__link")
        .withColumn("key", F.when(F.col("members").isNotNull(), F.struct("link", F.pmod(
            F.xxhash64("row", F.lit(1)), F.ceil(F.col("members") / F.lit(part))).alias("part"))))
        .withColumn("key", F.when(F.col("key").isNotNull(), F.concat_ws("/", F.col("key")["link"], F.col("key")["part"].cast("string"))))
        .withColumn("start", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), "rows")
    state = rows.where("key IS NOT NULL").groupBy("key", "start").agg(F.count("*").alias("n")).withColumn("shard", F.col("start"))
    # at most a few dozen groups are that large
    large = _large([tuple(r) for r in rows.where(F.col("members") > part).groupBy("link", "key").agg(F.count("*")).collect()], quota)
    state = state.withColumn("shard", F.coalesce(_lookup("key", large), "shard"))
    state = propagate(materialise(state, "labels"), quota, rounds, list(large))
    final = state.select(F.col("key").alias("__key"), F.col("start").alias("__start"), F.col("shard").alias("label"))
    rows = (rows.join(final, (F.col("key") == F.col("__key")) & (F.col("start") == F.col("__start")), "left")
            .drop("__key", "__start").withColumn("label", F.coalesce("label", F.lit(shards))))
    held = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    rows = numbered(rows, "label", "row", total)
    kept = [min(quota[b], held.get(b, 0)) for b in range(shards)]
    # rows beyond the quota of their label join the free ones, behind them
    shift, at = [0] * (shards + 1), held.get(shards, 0)
    for b in range(shards):
        shift[b] = at - kept[b]
        at += held.get(b, 0) - kept[b]
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("label") + 1)
    stays = F.col("number") < pick([*kept, 0])
    free = F.col("number") + pick(shift)
    shard, slot, start = F.lit(shards - 1), F.lit(0), 0
    for b in range(shards):
        end = start + quota[b] - kept[b]
        inside = (free >= start) & (free < end)
        shard = F.when(inside, b).otherwise(shard)
        slot = F.when(inside, free - start + kept[b]).otherwise(slot)
        start = end
    return (rows.withColumn("linked", F.col("key").isNotNull())
            .withColumn("shard", F.when(stays, F.col("label")).otherwise(shard).cast("int"))
            .withColumn("slot", F.when(stays, F.col("number")).otherwise(slot).cast("long"))
            .drop("key", "start", "label", "number", "members"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shards of documents, equal texts being linked: doc_id, size, text_crc32, law, shard, slot, grown_shard, linked.

    Size is the text's UTF-8 bytes plus 1; a null text has none, and isn't linked. Empty texts are equal texts. Repeated
    rows get a slot each. Columns other than doc_id and text are ignored. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(F.col("text").cast("binary"), 256).alias("link"), F.monotonically_increasing_id().alias("row")), "docs")
    return assign(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "linked", F.col("link").alias("group_key"))


@query("op6_shard_propagation")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return sharded(table(spark, folder, "documents"))
