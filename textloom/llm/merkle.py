"""Merkle manifest of a dataset: leaves, roots, proofs, and the check of altered rows.

Nodes are rows (tree, pos, digest); a run is up to FANOUT consecutive nodes. On
every level the slot-zero node of a run is equijoined with the nodes at its
slot offsets, and then emits the parent and the digests of its run. The join
is on the run number that both sides compute from their position, so they share
one exchange, and offsets are checked behind it. What a proof needs is handed
down the same levels, one row per run, so that a leaf meets it once.

Levels shrink by FANOUT; each has as many tasks as its nodes need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import placed, rank_from
from textloom.plans.lookup import lookup_join
from textloom.plans.storage import materialise

FANOUT = 16
# Fixed value: the columns of a leaf, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
# Every ROWS_APART-th row by the checksum of its id is altered in ``manifest``'s self-check.
ROWS_APART = 5
# Nodes per task of a level.
TASK_NODES = 100_000

_STEPS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the concatenated strings."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def altered_sample(id_col: Column) -> Column:
    """Whether the self-check alters a row; rows without an id stay as they are."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % ROWS_APART == 0, F.lit(False))


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves until one node is left."""
    return sum((F.when(n > FANOUT**k, 1).otherwise(0) for k in range(15)), F.lit(0))


def _tasks(n: int) -> int:
    return max(1, -(-n // TASK_NODES))


def _level(nodes: DataFrame, n: int) -> DataFrame:
    """(tree, height, run, digests, parent) from nodes (tree, height, pos, digest)."""
    run = F.call_function("div", F.col("pos"), F.lit(FANOUT))
    dealt = nodes.withColumn("run", run).repartition(_tasks(n), "tree", "run")
    siblings = dealt.select(F.col("tree").alias("t"), F.col("run").alias("r"), F.col("pos").alias("sibling"), F.col("digest").alias("d"))
    first = dealt.where(F.col("pos") % FANOUT == 0).select("tree", "height", "run", "pos")
    offset = F.col("sibling") - F.col("pos")
    same_run = (F.col("tree") == F.col("t")) & (F.col("run") == F.col("r")) & offset.between(0, FANOUT - 1)
    listed = first.join(siblings, same_run).groupBy("tree", "run").agg(
        F.first("height").alias("height"), F.array_sort(F.collect_list(F.struct("sibling", "d"))).alias("all")
    )
    digests = F.col("all.d")
    return listed.select("tree", "height", "run", digests.alias("digests"), digest(F.array_join(digests, "")).alias("parent"))


def _climb(leaves: DataFrame, n: int, top: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, and the roots (tree, height, digest) of all trees.

    ``leaves`` are nodes with the ``height`` of their tree, ``top`` is the greatest.
    """
    levels: list[DataFrame] = []
    roots = leaves.where("height = 0").select("tree", "height", "digest")
    nodes = leaves.where("height > 0").select("tree", "height", "pos", "digest")
    for k in range(top):
        level = materialise(_level(nodes, n), f"{label}-level")
        n = -(-n // FANOUT) if k else level.count()
        levels.append(level)
        parents = level.select("tree", "height", F.col("run").alias("pos"), F.col("parent").alias("digest"))
        roots = roots.unionByName(parents.where(F.col("height") == k + 1).drop("pos"))
        nodes = parents.where(F.col("height") > k + 1)
    return levels, roots


def _step(digests: Column, slot: Column) -> Column:
    """The siblings of a node, left and right of it."""
    return F.struct(
        F.array_join(F.slice(digests, F.lit(1), slot), "").alias("before"),
        F.array_join(F.slice(digests, slot + 2, F.lit(FANOUT)), "").alias("after"),
    )


def _hand_down(levels: list[DataFrame], tops: DataFrame, label: str) -> DataFrame:
    """(tree, run, digests, up) of the leaves: a run's digests and the siblings met above it.

    ``tops`` has (tree, height, up): what lies above the root of each tree. A
    tree of one leaf has a run without digests.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        starts = tops.where(F.col("height") == k + 1).select("tree", F.lit(0).cast("long").alias("run"), "up")
        above = starts if above is None else above.unionByName(starts)
        # one row per run: a sixteenth of the level's nodes
        full = levels[k].select("tree", "run", "digests").join(above, ["tree", "run"])
        if k:
            child = full.select("tree", "run", "digests", "up", F.posexplode("digests").alias("slot", "d"))
            above = materialise(
                child.select(
                    "tree",
                    (F.col("run") * FANOUT + F.col("slot")).alias("run"),
                    F.concat(F.array(_step(F.col("digests"), F.col("slot"))), F.col("up")).alias("up"),
                ),
                f"{label}-above",
            )
        else:
            above = full
    lone = tops.where("height = 0").select(
        "tree", F.lit(0).cast("long").alias("run"), F.lit(None).cast("array<string>").alias("digests"), "up"
    )
    return lone if above is None else above.unionByName(lone)


def _steps(nodes: DataFrame, runs: DataFrame) -> DataFrame:
    """``nodes`` with ``steps``: their siblings level by level up to the top."""
    run = F.call_function("div", F.col("pos"), F.lit(FANOUT))
    upper = runs.select(F.col("tree").alias("_t"), F.col("run").alias("_r"), "digests", "up")
    met = nodes.join(upper, (F.col("tree") == F.col("_t")) & (run == F.col("_r")))
    own = _step(F.col("digests"), (F.col("pos") % FANOUT).cast("int"))
    steps = F.when(F.col("digests").isNull(), F.col("up")).otherwise(F.concat(F.array(own), F.col("up")))
    return met.withColumn("steps", steps).drop("_t", "_r", "digests", "up")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf gives with its siblings."""
    return F.aggregate(steps, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def proof_digest(steps: Column) -> Column:
    parts = F.transform(steps, lambda s: F.concat(s["before"], s["after"]))
    return digest(F.array_join(parts, ""))


def _forest(nodes: DataFrame, counts: DataFrame, label: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """``nodes`` (tree, pos, digest, …) with the height of their tree, levels and roots; ``counts`` has (tree, n)."""
    heights = materialise(counts.select("tree", _height(F.col("n")).alias("height"), "n"), f"{label}-heights")
    total, top = heights.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("height"), F.lit(0))).first()
    # a tree may hold most of the leaves
    leaves = materialise(lookup_join(nodes, heights.drop("n"), ["tree"], salt_by=["pos"]), f"{label}-leaves")
    levels, roots = _climb(leaves, total, top, label)
    return leaves, levels, materialise(roots, f"{label}-roots")


def manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row per row of ``docs``.

    A leaf is the digest of FIELDS; the leaves of a source ascend by doc_id,
    null first, and make a tree of their own, whose root is the subroot. The
    subroots, by source, null first, then by UTF-8 bytes, make one tree more.
    ``proof_sha256`` is the digest of a leaf's siblings level by level, left to
    right. Rows where ``altered`` holds (default ``altered_sample``) have their
    text lower-cased in A-Z before they are folded with the original siblings;
    ``verified`` says whether that gave the root.

    Equal doc_ids of a source ascend by leaf; repeated rows are leaves of their
    own with alike digests. A source of one row has its leaf as subroot, one
    source alone has its subroot as root; no rows give no rows. Columns besides
    FIELDS take no part.
    """
    cells = {name: F.col(name) for name in FIELDS}
    changed = cells | {"text": lower_ascii(cells["text"])}
    leaf, other = (digest(*[field(c) for c in row.values()]) for row in (cells, changed))
    made = docs.select(
        F.col("doc_id").alias("id"),
        # null sorts before every source, the empty one included
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        leaf.alias("digest"),
        F.when(altered_sample(F.col("doc_id")) if altered is None else altered, other).alias("changed"),
    )
    # texts are read and hashed once; only the digests are dealt by ranges
    rows = materialise(made, "merkle-rows")
    ordered = placed(rows, ["tree", "id", "digest", "changed"], "merkle-ordered")
    nodes = rank_from(ordered, ["tree"], "pos")
    leaves, levels, roots = _forest(nodes, rows.groupBy("tree").agg(F.count("*").alias("n")), "merkle")

    tops = placed(roots.select(F.col("tree").alias("of"), F.col("height").alias("of_height"), "digest"), ["of"], "merkle-tops")
    upper = rank_from(tops, [], "pos").withColumn("tree", F.lit(""))
    upper, upper_levels, root = _forest(upper, upper.groupBy("tree").agg(F.count("*").alias("n")), "merkle-upper")
    over = _hand_down(upper_levels, root.select("tree", "height", F.array().cast(_STEPS).alias("up")), "merkle-upper")
    sources = materialise(
        _steps(upper.drop("height"), over).select(
            F.col("of").alias("tree"), F.col("of_height").alias("height"), F.col("steps").alias("up")
        ),
        "merkle-sources",
    )
    found = root.first()
    top = F.lit(found["digest"] if found else None).cast("string")

    proven = _steps(leaves.drop("height"), _hand_down(levels, sources, "merkle"))
    subroots = materialise(roots.select("tree", F.col("digest").alias("subroot")), "merkle-subroots")
    whole = lookup_join(proven, subroots, ["tree"], salt_by=["pos"])
    return whole.select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        top.alias("root"),
        proof_digest(F.col("steps")).alias("proof_sha256"),
        fold(F.coalesce("changed", "digest"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
