"""Sharding by balanced label propagation.

Rows with equal texts are linked. Groups larger than a shard start in whole shards,
each other linked row in an even spread over the rest; in every round the rows of a group ask to move to the shard that
holds most of their neighbours (those of a group larger than a shard to several),
in turn among all shards and among those with room, and a driver-side quota for
each pair of shards (a matrix of shards x shards) admits exchanges, free capacity
and cycles through full shards, largest gain first, until no move is admitted. Then groups that still
lie apart gather in shards with room for all of their rows, and rounds go on, until neither moves a row.
Rows without links have no preference and fill
what is left, so the counts of any two shards differ by one row at most.

Within a group and shard rows are alike, so the state of a round is one row for
each (group, shard), never a row for each link. DataFrame operations only.

Defined results: a null text has size 16, crc32 0 and no links; empty texts are
equal texts; repeated rows and null keys are rows like others; an empty table
gives an empty result. Law `rows`; grown_shard is null.
"""

from __future__ import annotations

import itertools
import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach_groups, materialize, shuffle_partitions, text_or_empty

log = logging.getLogger(__name__)

SHARDS = 40
#: None: until no move is admitted.
ROUNDS = None
#: Rounds in a row without an admitted move, half of them of each kind, that end the propagation.
IDLE = 4
#: Bytes that a row counts for where rows are numbered in parts, and parts of a large group to one of all rows.
ROW_BYTES, HOT_PARTS = 64, 4


def numbered(df: DataFrame, by: list[str], name: str, parts: int) -> DataFrame:
    """df with a gapless number from 0 within `by`, counted in `parts` parts by the hash of __uid.

    by must have few values: offsets, one row for each value and part, are broadcast.
    """
    df = df.withColumn("__part", F.pmod(F.xxhash64("__uid"), F.lit(parts)).cast("int"))
    counts = df.groupBy(*by, "__part").agg(F.count("*").alias("__count"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "__part", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"))
    ranked = df.withColumn("__within", F.row_number().over(Window.partitionBy(*by, "__part").orderBy("__uid")) - 1)
    out = ranked.join(F.broadcast(offsets), [*by, "__part"])
    return out.withColumn(name, F.col("__within") + F.col("__before")).drop("__part", "__within", "__before")


def shard_of(rank: str, ends: list[int]) -> Column:
    """The shard of a rank, where each shard takes the ranks below its end that those before it leave."""
    return F.aggregate(F.array(*[F.lit(e).cast("long") for e in ends]), F.lit(0), lambda n, e: n + (F.col(rank) >= e).cast("int"))


def quotas(want: dict[tuple[int, int], int], spare: list[int]) -> dict[tuple[int, int], int]:
    """Rows that may move from shard to shard: exchanges in pairs, then into free capacity, fullest wish first, then in cycles."""
    allowed = {(i, j): min(n, want.get((j, i), 0)) for (i, j), n in want.items()}
    room = list(spare)
    going = True
    while going:  # a move out of a full shard makes room there
        going = False
        for (i, j), n in sorted(want.items(), key=lambda x: (-x[1], x[0])):
            if (more := min(n - allowed[i, j], max(room[j], 0))) > 0:
                allowed[i, j] += more
                room[j] -= more
                room[i] += more
                going = True
    rest: dict[int, dict[int, int]] = {}
    for (i, j), n in sorted(want.items()):
        if n > allowed[i, j]:
            rest.setdefault(i, {})[j] = n - allowed[i, j]
    path: list[int] = []
    while rest:
        if not path:
            path.append(min(rest))
        onward = rest.get(path[-1])
        if not onward:  # no cycle leads through a shard that no row wishes to leave
            last = path.pop()
            rest.pop(last, None)
            if path:
                rest[path[-1]].pop(last)
            continue
        to = max(onward, key=lambda j: (onward[j], -j))
        if to not in path:
            path.append(to)
            continue
        cycle = [*path[path.index(to) :], to]
        steps = list(zip(cycle, cycle[1:]))
        n = min(rest[i][j] for i, j in steps)
        for i, j in steps:
            allowed[i, j] += n
            rest[i][j] -= n
            if not rest[i][j]:
                del rest[i][j]
        path = path[: path.index(to) + 1]
    return {k: n for k, n in allowed.items() if n}


def wished(state: DataFrame, spare: list[int], capacity: list[int], salt: int) -> DataFrame:
    """g, n, i, j, gain: rows that ask to move from shard i to shard j, where their group has more rows.

    Targets are the shards with spare places; without a list of those every
    shard, also a full one, which may give up all rows of other groups. Ties
    fall by salt, so that a wish without a partner may turn round.

    A group that fits any shard asks for one target.
    A larger one fills its targets one after the other, the fullest first, from
    its smallest shards; such groups are fewer than the shards, so their rows are
    broadcast. A target only gains and a source only loses, and a target has at
    least as many rows, so moves always raise the sum of n x n.
    """
    weight = F.struct(F.col("n"), F.xxhash64("g", "shard", F.lit(salt)), F.col("shard"))
    per_group = Window.partitionBy("g")
    least = min(capacity)
    room = F.element_at(F.array(*[F.lit(x).cast("long") for x in spare or capacity]), F.col("shard") + 1)
    rows = state.withColumn("room", room if spare else room - F.col("n"))
    rows = rows.withColumn("weight", weight).withColumn("size", F.sum("n").over(per_group))
    rows = rows.withColumn("best", F.max(F.when(F.col("room") > 0, F.col("weight")) if spare else F.col("weight")).over(per_group))
    small = rows.filter((F.col("size") <= least) & (F.col("weight") < F.col("best")))
    small = small.select("g", "n", F.col("shard").alias("i"), F.col("best.shard").alias("j"), (F.col("best.n") - F.col("n")).alias("gain"))

    large = rows.filter(F.col("size") > least)
    upward, downward = per_group.orderBy("weight"), per_group.orderBy(F.desc("weight"))
    source = large.select("g", F.col("shard").alias("i"), F.col("n").alias("__n"), F.col("weight").alias("__own"), F.sum("n").over(upward).alias("__s"))
    target = large.select("g", F.col("shard").alias("j"), F.col("n").alias("__to"), F.col("weight").alias("__other"), "room", F.sum("room").over(downward).alias("__r"))
    overlap = F.least("__s", "__r") - F.greatest(F.col("__s") - F.col("__n"), F.col("__r") - F.col("room"))
    large = source.join(F.broadcast(target.filter("room > 0")), "g").withColumn("n", overlap).filter((F.col("n") > 0) & (F.col("__own") < F.col("__other")))
    return small.unionByName(large.select("g", "n", "i", "j", (F.col("__to") - F.col("__n")).alias("gain")))


def gathered(state: DataFrame, spare: list[int], salt: int) -> DataFrame:
    """g, i, j, n: the rows of groups that lie apart and as a whole fit the spare places of one shard, which they all move to.

    The groups are laid, in an order that the salt decides, along the spare places
    of all shards; those that lie within one shard's places take them.
    """
    room = max(max(spare), 0)
    ends = list(itertools.accumulate(max(x, 0) for x in spare))
    apart = state.groupBy("g").agg(F.sum("n").alias("size"), F.count("*").alias("shards")).filter((F.col("shards") > 1) & (F.col("size") <= room))
    laid = apart.withColumn("__part", F.pmod(F.xxhash64("g", F.lit(salt)), F.lit(shuffle_partitions(state.sparkSession))).cast("int"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    starts = laid.groupBy("__part").agg(F.sum("size").alias("s")).select("__part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("__start"))
    inner = Window.partitionBy("__part").orderBy(F.xxhash64("g", F.lit(salt)), "g").rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.withColumn("__at", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(F.broadcast(starts), "__part")
    laid = laid.withColumn("first", F.col("__at") + F.col("__start")).withColumn("last", F.col("first") + F.col("size") - 1)
    laid = laid.withColumn("j", shard_of("first", ends)).filter((F.col("j") == shard_of("last", ends)) & (F.col("j") < len(spare)))
    return state.join(laid.select("g", "j"), "g").filter(F.col("shard") != F.col("j")).select("g", F.col("shard").alias("i"), "j", "n")


def moves(change: DataFrame) -> DataFrame:
    """g, shard, n: what rows g, i, j, m take from shards and add to them."""
    return change.select("g", F.inline(F.array(F.struct(F.col("i").alias("shard"), (-F.col("m")).alias("n")), F.struct(F.col("j").alias("shard"), F.col("m").alias("n")))))


def propagate(state: DataFrame, capacity: list[int], rounds: int | None = ROUNDS) -> DataFrame:
    """state: g, shard, n (rows of group g in shard). Returns it when no move is admitted, or after the rounds; no shard exceeds its capacity."""
    spark, shards, idle = state.sparkSession, len(capacity), 0
    for k in itertools.count() if rounds is None else range(rounds):
        used = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row a shard
        spare = [capacity[s] - used.get(s, 0) for s in range(shards)]
        # in turn: any shard may be wished for, and rows change places; then only shards with room
        if exchange := k % 2 == 0:
            wishes = wished(state, [], capacity, k)
        else:
            wishes = wished(state, spare, capacity, k)
        wishes = materialize(wishes, f"shard-wishes-{k}")
        want = {(r["i"], r["j"]): r["n"] for r in wishes.groupBy("i", "j").agg(F.sum("n").alias("n")).collect()}  # shards x shards
        if exchange and not want:
            break  # every group has met
        allowed = quotas(want, spare)
        idle = 0 if allowed else idle + 1
        if idle == IDLE:
            # rows that wish in vain: groups that lie apart may still meet where there is room for all of them
            change = materialize(gathered(state, spare, k), f"shard-gathered-{k}")
            if change.isEmpty():
                break
            state = state.unionByName(moves(change.withColumnRenamed("n", "m"))).groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0")
            state, idle = materialize(state, f"shard-state-{k}"), 0
            log.debug("round %d: groups gathered", k)
            continue
        if not allowed:
            continue
        quota = spark.createDataFrame([(i, j, n) for (i, j), n in allowed.items()], "i int, j int, quota long")
        order = Window.partitionBy("i", "j").orderBy(F.desc("gain"), F.xxhash64("g"), "g").rowsBetween(Window.unboundedPreceding, -1)
        moved = wishes.withColumn("__before", F.coalesce(F.sum("n").over(order), F.lit(0))).join(F.broadcast(quota), ["i", "j"])
        moved = moved.withColumn("m", F.least("n", F.greatest(F.col("quota") - F.col("__before"), F.lit(0)))).filter("m > 0")
        state = state.unionByName(moves(moved)).groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0")
        state = materialize(state, f"shard-state-{k}")
        log.debug("round %d: %d rows wish to move, %d may", k, sum(want.values()), sum(allowed.values()))
    return state


def balanced_shards(df: DataFrame, text: str = "text", key: str = "doc_id", shards: int = SHARDS, rounds: int | None = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and linked: whether another row has the same text."""
    spark = df.sparkSession
    content = text_or_empty(text)
    base = df.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.sha1(F.col(text).cast("binary"))).alias("g"),
        F.monotonically_increasing_id().alias("__uid"),
    )
    base = materialize(base, "shard-rows")
    total = base.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    parts = shuffle_partitions(spark, total * ROW_BYTES)

    sizes = base.filter("g is not null").groupBy("g").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    base = materialize(attach_groups(base, sizes, "g", "group_size", total, "__uid"), "shard-linked")
    linked, free = base.filter("group_size is not null"), base.filter("group_size is null")

    # the start: groups larger than a shard, fewer than the shards, fill whole shards one after the other ...
    large = sizes.filter(F.col("group_size") > min(capacity)).orderBy(F.desc("group_size"), "g").collect()
    packed, left, s = [], list(capacity), 0
    for g, n in large:
        while n:
            m = min(n, left[s])
            if m:
                packed.append((g, s, m))
            n, left[s] = n - m, left[s] - m
            s += not left[s]
    # ... and the other linked rows spread over what is left in even shares, which never exceed it
    start = linked.filter(F.col("group_size") <= min(capacity)).select("__uid", "g")
    many, open_places = start.count(), sum(left)
    start = numbered(start, [], "__n", parts).withColumn("shard", shard_of("__n", [n * many // max(open_places, 1) for n in itertools.accumulate(left)]))
    state = start.groupBy("g", "shard").agg(F.count("*").alias("n"))
    state = state.unionByName(spark.createDataFrame(packed, "g string, shard int, n long"))
    state = propagate(materialize(state, "shard-state"), capacity, rounds)

    used = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    # where the rows of a group go: at most `shards` entries (end of the range of ranks, shard)
    upto = F.sum("n").over(Window.partitionBy("g").orderBy("shard"))
    places = state.withColumn("upto", upto).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("places"), F.sum("n").alias("group_size"))
    hot = F.when(F.col("group_size") > max(total // 1000, 1), F.pmod(F.xxhash64("__uid"), F.lit(HOT_PARTS * parts)).cast("int")).otherwise(0)
    linked = linked.withColumn("__part", hot)
    counts = linked.groupBy("g", "__part").agg(F.count("*").alias("__count"))
    before = F.coalesce(F.sum("__count").over(Window.partitionBy("g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("g", "__part", before.alias("__before"))
    linked = linked.withColumn("__rank", F.row_number().over(Window.partitionBy("g", "__part").orderBy("__uid")) - 1).join(offsets, ["g", "__part"])
    linked = linked.withColumn("__rank", F.col("__rank") + F.col("__before")).drop("__part", "__before", "group_size")
    linked = attach_groups(linked, places, "g", "group_size", total, "__uid")
    place = F.filter("places", lambda x: x["upto"] > F.col("__rank"))
    linked = linked.withColumn("shard", F.element_at(place, 1)["shard"])

    # rows without links fill what is left of each shard
    ends = list(itertools.accumulate(capacity[s] - used.get(s, 0) for s in range(shards)))
    free = numbered(free, [], "__rank", parts)
    free = free.withColumn("shard", shard_of("__rank", ends))

    columns = ["doc_id", "size", "text_crc32", "shard", "__uid"]
    placed = linked.select(*columns, F.lit(True).alias("linked")).unionByName(free.select(*columns, F.lit(False).alias("linked")))
    placed = numbered(materialize(placed, "shard-placed"), ["shard"], "slot", parts)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "linked")
