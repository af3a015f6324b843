"""Sharding by balanced label propagation over links between equal texts.

Documents start dealt evenly over the shards. Every round, linked documents
move towards the shard that holds most of their neighbours, as far as quotas allow
or as many move back around a circle of shards; documents without links then
fill what is left, so that row counts differ by one at most. Neighbours are never
listed: documents of one group are alike, so a group is one row of at most
a cell (shard, count) per shard, however large it is. A round reads these rows
once to collect wishes, joins them with what was granted, and writes them again.

Every move makes the larger of two cells of a group larger, so the number of
uncut links grows with every round and propagation ends by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import placed, rank_from
from textloom.plans.lookup import lookup_join
from textloom.plans.storage import discard, materialise

SHARDS = 40
OVERHEAD = 16
# Wishes that are read and granted one by one; of more, only those at the edge of what is granted.
EXACT = 50_000
# Ranges of the hashed turn by which larger numbers of wishes are counted, level by level.
FANOUT = 64
TURN_BITS = 30
# Orders of equally full cells that are tried before propagation ends.
TIES = 4
# Groups per task of a round.
TASK_GROUPS = 50_000

Flows = dict[tuple[int, int], int]  # (from shard, to shard) -> rows


def quota(shard: int, total: int, shards: int) -> int:
    """Rows of ``shard``: equal, the first shards one more."""
    return total // shards + (shard < total % shards)


def _start(rows: DataFrame, shards: int) -> DataFrame:
    """Rows dealt out in id order: the one with position p goes to shard p modulo ``shards``."""
    ordered = placed(rows, ["doc_id", "grp", "size"], "shard-order")
    return materialise(
        rank_from(ordered, [], "pos").withColumn("shard", (F.col("pos") % shards).cast("int")), "shard-start"
    )


def _wishes(groups: DataFrame, room: list[int], only_free: bool, salt: int) -> DataFrame:
    """``groups`` (grp, cells) with ``to`` and ``turn``: where a group gathers, and its hashed place in the queue.

    The target is the fullest cell, with ``only_free`` the fullest among shards
    with room. Ties differ from group to group, so that targets spread, and with ``salt``.
    """
    rooms = F.array(*[F.lit(r).cast("long") for r in room])
    cells = F.filter("cells", lambda c: F.get(rooms, c["shard"]) > 0) if only_free else F.col("cells")
    ranked = F.transform(
        cells, lambda c: F.struct(c["n"].alias("n"), F.xxhash64(F.col("grp"), c["shard"], F.lit(salt)).alias("tie"), c["shard"].alias("shard"))
    )
    turn = F.shiftrightunsigned(F.xxhash64("grp", F.lit(1)), 64 - TURN_BITS)
    return groups.withColumn("best", F.array_max(ranked)).select(
        "grp", "cells", F.col("best.shard").alias("to"), F.col("best.n").alias("most"), turn.alias("turn")
    )


def _asks(cell: Column) -> Column:
    """Whether a cell of a group asks to move: it is not the target and not larger than it."""
    return (cell["shard"] != F.col("to")) & (cell["n"] <= F.col("most"))


def flows(asked: Flows, room: list[int]) -> Flows:
    """How much of every wish can be granted so that no shard exceeds its room.

    Circles first, in which every shard gives what it takes; the rest goes to
    shards with room, beginning with those that have nothing more to give.
    """
    left = {k: n for k, n in sorted(asked.items()) if n > 0}
    granted: Flows = {}

    def grant(pair: tuple[int, int], n: int) -> None:
        granted[pair] = granted.get(pair, 0) + n
        left[pair] -= n
        if not left[pair]:
            del left[pair]

    def circle() -> list[int] | None:
        done: set[int] = set()
        for root in sorted({s for s, _ in left}):
            path, on = [root], {root}
            branches = [iter(sorted(t for s, t in left if s == root))]
            while branches:
                step = next(branches[-1], None)
                if step is None:
                    done.add(path[-1])
                    on.discard(path.pop())
                    branches.pop()
                elif step in on:
                    return path[path.index(step) :]
                elif step not in done:
                    path.append(step)
                    on.add(step)
                    branches.append(iter(sorted(t for s, t in left if s == step)))
        return None

    for s, t in sorted(left):
        if s < t and (s, t) in left and (t, s) in left:
            n = min(left[s, t], left[t, s])
            grant((s, t), n)
            grant((t, s), n)
    while found := circle():
        pairs = list(zip(found, found[1:] + found[:1]))
        n = min(left[p] for p in pairs)
        for p in pairs:
            grant(p, n)
    free = list(room)
    waiting = {s for pair in left for s in pair}
    while waiting:
        # without circles there is always a shard whose own wishes have all been looked at
        last = min(t for t in waiting if not any(s == t and u in waiting for s, u in left))
        waiting.discard(last)
        for s, t in sorted(p for p in left if p[1] == last):
            n = min(left[s, t], max(0, free[t]))
            if n:
                free[t] -= n
                free[s] += n
                grant((s, t), n)
    return granted


def _grant(wishes: DataFrame, room: list[int]) -> tuple[Flows, Flows, list[tuple[bytes, int, int]]]:
    """(flows, bounds, grants): turns below the bound of a pair are granted, and what ``grants`` names (grp, shard, n).

    All wishes of a pair are granted in the order of their turns, the last one
    in part.
    """
    rows = wishes.select("grp", "turn", "to", F.explode(F.filter("cells", _asks)).alias("c")).select(
        "grp", "turn", "to", F.col("c.shard").alias("shard"), F.col("c.n").alias("n")
    )
    near = rows.limit(EXACT + 1).collect()
    bounds: Flows = {}
    if len(near) <= EXACT:
        asked: Flows = {}
        for r in near:
            asked[r["shard"], r["to"]] = asked.get((r["shard"], r["to"]), 0) + r["n"]
        found = flows(asked, room)
        left = dict(found)
    else:
        # a row per two shards and range of turns
        span, edge = 1 << TURN_BITS, {}
        asked = {(r["shard"], r["to"]): r["n"] for r in rows.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
        found = flows(asked, room)
        left = {p: n for p, n in found.items() if n < asked[p]}
        bounds = {p: span for p, n in found.items() if n == asked[p]}
        edge = {p: 0 for p in left}
        at_edge = rows
        while edge and span > 1:
            low = F.create_map(*[F.lit(x) for s, t in edge for x in (s * len(room) + t, edge[s, t])])
            begins = F.try_element_at(low, F.col("shard") * len(room) + F.col("to"))
            at_edge = rows.where((F.col("turn") >= begins) & (F.col("turn") < begins + span))
            if span < 1 << TURN_BITS and len(near := at_edge.limit(EXACT + 1).collect()) <= EXACT:
                break
            span //= FANOUT
            place = F.call_function("div", F.col("turn") - begins, F.lit(span))
            counts: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for r in at_edge.groupBy("shard", "to", place.alias("place")).agg(F.sum("n").alias("n")).collect():
                counts.setdefault((r["shard"], r["to"]), []).append((r["place"], r["n"]))
            for pair, parts in counts.items():
                for slot, n in sorted(parts):
                    if n > left[pair]:
                        edge[pair] += slot * span
                        break
                    left[pair] -= n
        else:
            near = at_edge.collect() if edge else []  # groups of one turn: their hashes agree in TURN_BITS bits
        bounds |= edge
    grants = []
    for r in sorted(near, key=lambda r: (r["turn"], r["grp"])):
        n = min(r["n"], left.get((r["shard"], r["to"]), 0))
        if n:
            left[r["shard"], r["to"]] -= n
            grants.append((bytes(r["grp"]), r["shard"], n))
    return found, bounds, grants


def _moved(wishes: DataFrame, bounds: Flows, grants: list[tuple[bytes, int, int]], shards: int) -> DataFrame:
    """(grp, cells) after the granted moves."""
    spark = wishes.sparkSession
    table = spark.createDataFrame(grants, "g binary, shard int, n long").groupBy("g").agg(
        F.collect_list(F.struct("shard", "n")).alias("given")
    )
    joined = wishes.join(F.broadcast(table), F.col("grp") == F.col("g"), "left")  # at most EXACT rows
    pairs = [x for (s, t), bound in bounds.items() for x in (F.lit(s * shards + t), F.lit(bound))]
    bound = F.create_map(*pairs) if pairs else F.lit(None).cast("map<int,int>")

    def leaves(cell: Column) -> Column:
        by_name = F.aggregate(
            F.filter("given", lambda x: x["shard"] == cell["shard"]), F.lit(0).cast("long"), lambda a, x: a + x["n"]
        )
        by_turn = F.when(F.col("turn") < F.try_element_at(bound, cell["shard"] * shards + F.col("to")), cell["n"])
        return F.when(_asks(cell), F.coalesce(by_turn, by_name, F.lit(0))).otherwise(0)

    with_moves = joined.withColumn(
        "parts", F.transform("cells", lambda c: F.struct(c["shard"].alias("shard"), c["n"].alias("n"), leaves(c).alias("gone")))
    )
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["gone"])
    arrived = with_moves.withColumn("arrived", total)
    moved = F.transform(
        "parts",
        lambda p: F.struct(
            p["shard"].alias("shard"),
            (p["n"] - p["gone"] + F.when(p["shard"] == F.col("to"), F.col("arrived")).otherwise(0)).alias("n"),
        ),
    )
    return arrived.select("grp", F.filter(moved, lambda c: c["n"] > 0).alias("cells"))


def propagate(groups: DataFrame, quotas: list[int]) -> DataFrame:
    """Groups (grp, cells) after propagation, until no wish can be granted whichever way ties go (TIES ways are tried).

    ``groups`` is a written table with a row per group, its cells an array of
    (shard, n) with each shard at most once.
    """
    loads = groups.select(F.explode("cells").alias("c")).groupBy("c.shard").agg(F.sum("c.n").alias("n")).collect()
    used = {r["shard"]: r["n"] for r in loads}  # one row per shard
    room = [q - used.get(s, 0) for s, q in enumerate(quotas)]
    tasks = max(1, -(-groups.count() // TASK_GROUPS))
    salt = idle = 0
    # targets among all shards, then among those with room, then with ties the other way
    while idle < 2 * TIES:
        wishes = _wishes(groups.coalesce(tasks), room, idle % 2 == 1, salt + idle // 2)
        found, bounds, grants = _grant(wishes, room)
        if not sum(found.values()):
            idle += 1
            continue
        groups, done = materialise(_moved(wishes, bounds, grants, len(quotas)), "shard-groups"), groups
        discard(done)
        for (s, t), n in found.items():
            room[s] += n
            room[t] -= n
        salt, idle = salt + idle // 2, 0
    return groups


def cut_links(groups: DataFrame) -> DataFrame:
    """(links, cut): pairs of equal texts, and those that lie in two shards."""

    def pairs(n: Column) -> Column:
        return n * (n - 1) / 2

    total = F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + c["n"])
    inside = F.aggregate("cells", F.lit(0.0), lambda a, c: a + pairs(c["n"]))
    sums = groups.select(pairs(total).alias("links"), inside.alias("inside"))
    return sums.agg(F.sum("links").alias("links"), F.sum(F.col("links") - F.col("inside")).alias("cut"))


def linked_groups(start: DataFrame) -> DataFrame:
    """(grp, cells) of the groups of more than one row."""
    counted = start.groupBy("grp", "shard").agg(F.count("*").alias("n"))
    cells = F.array_sort(F.collect_list(F.struct("shard", "n")))  # a cell per shard
    return counted.groupBy("grp").agg(cells.alias("cells"), F.sum("n").alias("_n")).where("_n > 1").drop("_n")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), row counts at most one apart.

    ``size`` is the UTF-8 length plus OVERHEAD; a null text is empty. Equal
    texts are linked; repeated rows are documents of their own; null ids come
    first in the order. ``slot`` counts from 0 in id order within a shard.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(whole).cast("long") + OVERHEAD).alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.unhex(F.md5(whole)).alias("grp"),
    )
    start = _start(materialise(rows, "shard-rows"), shards)
    total = start.count()
    quotas = [quota(s, total, shards) for s in range(shards)]
    final = propagate(materialise(linked_groups(start), "shard-groups"), quotas)
    placed_rows = _place(start, final, quotas)
    ranked = rank_from(placed(placed_rows, ["shard", "doc_id", "pos"], "shard-slots"), ["shard"], "slot")
    return ranked.select("doc_id", "size", "text_crc32", "shard", "slot")


def _pick(shards: Column, counts: Column, rank: Column) -> Column:
    """The shard whose interval of running counts holds ``rank``."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("int").alias("shard"))
    found = F.aggregate(
        F.arrays_zip(shards.alias("shard"), counts.alias("n")),
        start,
        lambda a, c: F.struct(
            (a["sum"] + c["n"]).alias("sum"),
            F.when(a["shard"].isNull() & (rank < a["sum"] + c["n"]), c["shard"]).otherwise(a["shard"]).alias("shard"),
        ),
    )
    return found["shard"]


def _place(start: DataFrame, groups: DataFrame, quotas: list[int]) -> DataFrame:
    """Rows by their rank in the group, dealt to its cells in shard order; rows without links fill the room left."""
    cells = F.array_sort("cells")
    table = materialise(groups.select("grp", cells["shard"].alias("to"), cells["n"].alias("counts")), "shard-cells")
    used = {r["s"]: r["n"] for r in table.select(F.explode(F.arrays_zip("to", "counts")).alias("c")).groupBy(
        F.col("c.to").alias("s")).agg(F.sum("c.counts").alias("n")).collect()}  # one row per shard
    # a group may hold a third of all rows; without links there is no group
    met = lookup_join(start.drop("shard"), table, ["grp"], salt_by=["pos"], how="left")
    rows = met.withColumn("grp", F.when(F.col("to").isNotNull(), F.col("grp")))
    ranked = rank_from(placed(rows, ["grp", "pos"], "shard-members"), ["grp"], "_rank")
    free_to = F.array(*[F.lit(s) for s in range(len(quotas))])
    free = F.array(*[F.lit(q - used.get(s, 0)).cast("long") for s, q in enumerate(quotas)])
    shard_of = _pick(F.coalesce("to", free_to), F.coalesce("counts", free), F.col("_rank"))
    return ranked.select("doc_id", "size", "text_crc32", shard_of.alias("shard"), "pos")
