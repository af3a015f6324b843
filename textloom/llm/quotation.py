"""Quotation linking: from messages that quote each other to reply-ordered conversations.

Lines are parsed into quote level and content. A passage is a run of lines of
one level, blank ones aside. Hashes of normalised runs of lines, built by doubling,
are joined to the runs of earlier messages' own lines: a passage links to the
message that says its longest run of lines, among equals to the latest. The result has
every message once, without its quotes, with the message it answers and its
place on a branch of the conversation.

Whether an earlier message says a run is one join with its first sayer, so
neither a line that everybody says nor one that everybody quotes makes pairs; the
latest sayer is a running maximum over sorted runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import placed, rank_from
from textloom.plans.lookup import lookup_join
from textloom.plans.storage import discard, materialise

# One or more quote marks at the start of a line, each perhaps followed by a space.
QUOTE = r"^\s*(?:>\s?)+"


def _normal(line: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), r"\s+", " "))


def parse(text: Column) -> Column:
    """Lines of a text as structs (level, line): quote marks counted and taken off."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")

    def cut(line: Column) -> Column:
        marks = F.regexp_extract(line, QUOTE, 0)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.when(F.length(marks) > 0, F.regexp_replace(line, QUOTE, "")).otherwise(line).alias("line"),
        )

    return F.transform(lines, cut)


def own_text(lines: Column) -> Column:
    """What a message says itself: its lines of level 0, trimmed as a whole."""
    own = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["line"])
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def passages(lines: Column) -> Column:
    """Runs of quoted lines of one level, as structs (level, hashes); blank lines are passed over."""
    start = F.struct(
        F.lit(0).alias("level"), F.array().cast("array<struct<level:int,hashes:array<bigint>>>").alias("done"),
        F.array().cast("array<bigint>").alias("run"),
    )

    def closed(a: Column) -> Column:
        whole = F.struct(a["level"].alias("level"), a["run"].alias("hashes"))
        return F.when((a["level"] > 0) & (F.size(a["run"]) > 0), F.concat(a["done"], F.array(whole))).otherwise(a["done"])

    def step(a: Column, x: Column) -> Column:
        normal = _normal(x["line"])
        line = F.array(F.xxhash64(normal))
        same = x["level"] == a["level"]
        joined = F.struct(a["level"].alias("level"), a["done"].alias("done"), F.concat(a["run"], line).alias("run"))
        opened = F.struct(x["level"].alias("level"), closed(a).alias("done"), line.alias("run"))
        return F.when(F.length(normal) == 0, a).when(same, joined).otherwise(opened)

    return F.aggregate(lines, start, step, closed)


def own_hashes(lines: Column) -> Column:
    """Hashes of a message's own lines in order, blank ones left out."""
    said = F.filter(F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: _normal(x["line"])), lambda t: F.length(t) > 0)
    return F.transform(said, lambda t: F.xxhash64(t))


def doubled(hashes: Column, levels: int) -> Column:
    """Array of arrays: entry k has the hashes of all runs of 2 to the k lines, k up to ``levels``."""

    def longer(a: Column, k: Column) -> Column:
        last = F.element_at(a, -1)
        half = F.call_function("shiftleft", F.lit(1), k - 1)
        n = F.greatest(F.size(last) - half, F.lit(0))
        pairs = F.zip_with(F.slice(last, F.lit(1), n), F.slice(last, half + 1, n), lambda x, y: F.xxhash64(x, y))
        return F.concat(a, F.array(pairs))

    if levels == 0:
        return F.array(hashes)
    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array(hashes), longer)


def runs_of(table: Column, n: Column) -> Column:
    """Keys of all runs of ``n`` lines: the two runs of a power of two that cover each."""
    k = F.floor(F.log2(n.cast("double") + 0.5)).cast("int")
    power = F.element_at(table, k + 1)
    shift = n - F.call_function("shiftleft", F.lit(1), k)
    count = F.greatest(F.size(power) - shift, F.lit(0))
    return F.zip_with(
        F.slice(power, F.lit(1), count), F.slice(power, shift + 1, count), lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    )


_RUN = ["ck", "n", "a", "b"]


def _said(talkers: DataFrame, lengths: DataFrame) -> DataFrame:
    """(ck, seq, n, a, b): the runs of own lines, of the lengths asked for in their conversation."""
    # few lengths per conversation, but a conversation may hold a third of all messages
    wanted = lookup_join(talkers, lengths, ["ck"], salt_by=["seq"])
    sized = wanted.select("ck", "seq", "said", F.explode("lengths").alias("n")).where(F.size(F.col("said")[0]) >= F.col("n"))
    return sized.select("ck", "seq", "n", F.inline(F.array_distinct(runs_of(F.col("said"), F.col("n"))))).distinct()


def _asked(tested: DataFrame) -> DataFrame:
    return materialise(tested.groupBy("ck").agg(F.collect_set("n").alias("lengths")), "quote-lengths")


def _longest(quotes: DataFrame, talkers: DataFrame, most: int) -> DataFrame:
    """``quotes`` (ck, seq, passage, m, table) with ``best``: lines of the longest run that an earlier message says.

    If a run is said, so are its parts, so the length is found bit by bit;
    whole passages are tried first.
    """

    def holds(tested: DataFrame) -> DataFrame:
        """(ck, seq, passage) of those whose run of ``n`` lines an earlier message says."""
        firsts = materialise(_said(talkers, _asked(tested)).groupBy(*_RUN).agg(F.min("seq").alias("first")), "quote-firsts")
        runs = tested.select("ck", "seq", "passage", "n", F.inline(F.array_distinct(runs_of(F.col("table"), F.col("n")))))
        met = lookup_join(runs, firsts, _RUN, salt_by=["seq", "passage"]).where(F.col("first") < F.col("seq"))
        return met.select("ck", "seq", "passage").distinct().withColumn("held", F.lit(True))

    keys = ["ck", "seq", "passage"]
    whole = materialise(holds(quotes.withColumn("n", F.col("m"))), "quote-whole")
    found = materialise(
        quotes.join(whole, keys, "left").select(
            *quotes.columns, F.when(F.col("held"), F.col("m")).otherwise(0).alias("best"), F.coalesce("held", F.lit(False)).alias("whole")
        ),
        "quote-best",
    )
    bit = 1 << max(0, most.bit_length() - 1)
    while bit and found.where("NOT whole").limit(1).count():
        tested = found.withColumn("n", F.col("best") + bit).where(~F.col("whole") & (F.col("n") < F.col("m")))
        held = holds(tested.select(*keys, "table", "n"))
        grown = found.join(held, keys, "left").withColumn("best", F.col("best") + F.when(F.col("held"), bit).otherwise(0))
        found, done = materialise(grown.drop("held"), "quote-best"), found
        discard(done)
        bit //= 2
    return found.drop("whole")


def _latest(quotes: DataFrame, talkers: DataFrame) -> DataFrame:
    """(ck, seq, passage, original): the latest earlier message that says one of the passage's runs of ``best`` lines."""
    ready = quotes.where("best > 0").withColumn("n", F.col("best"))
    asked = ready.select("ck", "seq", "passage", "n", F.inline(F.array_distinct(runs_of(F.col("table"), F.col("n")))))
    said = _said(talkers, _asked(ready))
    # at one place in the order a message asks before it says
    events = asked.select(*_RUN, "seq", F.lit(0).alias("says"), "passage").unionByName(
        said.select(*_RUN, "seq", F.lit(1).alias("says"), F.lit(None).cast("int").alias("passage"))
    )
    rows = placed(materialise(events, "quote-events"), [*_RUN, "seq", "says", "passage"], "quote-order")
    speaker = F.when(F.col("says") == 1, F.col("seq"))
    parts = rows.groupBy("_part", *_RUN).agg(F.max(speaker).alias("_max"))
    earlier = Window.partitionBy(*_RUN).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_part", *_RUN, F.max("_max").over(earlier).alias("_carried"))
    inside = Window.partitionBy("_part", *_RUN).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.max(speaker).over(inside)).where("says = 0")
    last = local.join(carried, ["_part", *_RUN]).withColumn("original", F.greatest("_local", "_carried"))
    return last.groupBy("ck", "seq", "passage").agg(F.max("original").alias("original"))


def _links(messages: DataFrame) -> DataFrame:
    """(ck, seq, level, best, original): passages with the lines of their longest run and the message that says it."""
    cut = messages.where(F.exists("lines", lambda x: x["level"] > 0)).select(
        "ck", "seq", F.posexplode(passages(F.col("lines"))).alias("passage", "p")
    )
    quotes = materialise(cut.select("ck", "seq", "passage", "p.level", "p.hashes", F.size("p.hashes").alias("m")), "quote-passages")
    most = quotes.agg(F.max("m")).first()[0]
    if most is None:
        return quotes.select("ck", "seq", "level", F.col("m").alias("best"), F.col("seq").alias("original"))
    levels = most.bit_length() - 1
    quoting = materialise(quotes.select("ck").distinct(), "quote-conversations")
    talkers = materialise(
        lookup_join(messages.select("ck", "seq", own_hashes(F.col("lines")).alias("own")), quoting, ["ck"], salt_by=["seq"])
        .where(F.size("own") > 0)
        .select("ck", "seq", doubled(F.col("own"), levels).alias("said")),
        "quote-said",
    )
    ready = quotes.select("ck", "seq", "passage", "level", "m", doubled(F.col("hashes"), levels).alias("table"))
    found = _longest(materialise(ready, "quote-runs"), talkers, most)
    latest = _latest(found, talkers)
    return found.join(latest, ["ck", "seq", "passage"]).select("ck", "seq", "level", "best", "original")


def _messages(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Numbered messages with parsed lines; ``seq`` orders a conversation densely, repeated turns by role and text.

    ``ck`` is a key of the conversation that is never null.
    """
    rows = conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).cast("string").alias("raw")
    )
    ranked = rank_from(placed(rows, ["conv_id", "turn", "role", "raw"], "quote-rows"), ["conv_id"], "seq")
    ck = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    return ranked.withColumns({"lines": parse(F.col("raw")), "ck": ck}).drop("raw")


def link(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per message: conv_id, turn, role, text, n_quoted, n_linked, parent_turn, branch, place.

    ``text`` has no quotes. The parent is the message whose words are quoted at
    the outermost level, by the longest run of lines of a passage, among equals the latest;
    without such a quote it is the message before, and the first message
    has none. ``n_quoted`` counts quoted lines that are not blank, ``n_linked`` those in the
    longest run of each passage that an earlier message says. The first answer
    to a message goes on with its branch, every other one opens a branch named by
    its own turn; ``place`` counts from 0 along a branch, so branch and place give
    the reply order.

    Null texts say nothing; null conversation ids form one conversation; null
    turns come first. Repeated turns are messages of their own, ordered by role
    and text, and share the name of their branches. Other columns are left out.
    """
    messages = materialise(_messages(conversations, conv, turn, role, text), "quote-messages")
    links = materialise(_links(messages), "quote-links")
    chosen = F.max(F.when(F.col("level") == 1, F.struct("best", "original")))["original"]
    parents = links.groupBy("ck", "seq").agg(chosen.alias("quoted_parent"), F.sum("best").alias("n_linked"))
    quoted_lines = F.size(F.filter("lines", lambda x: (x["level"] > 0) & (F.length(_normal(x["line"])) > 0)))
    told = messages.join(parents, ["ck", "seq"], "left").select(
        "ck",
        "conv_id",
        "seq",
        "turn",
        "role",
        own_text(F.col("lines")).alias("text"),
        quoted_lines.cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("quoted_parent", F.when(F.col("seq") > 0, F.col("seq") - 1)).alias("parent"),
    )
    told = materialise(told, "quote-told")
    turns = told.select("ck", F.col("seq").alias("parent"), F.col("turn").alias("parent_turn"))
    # a message may be answered by a third of all others
    answered = lookup_join(told, turns, ["ck", "parent"], salt_by=["seq"], how="left")
    branches = _branches(told.select("ck", "seq", "turn", "parent"))
    joined = answered.join(branches, ["ck", "seq"])
    return joined.select(
        "conv_id", "turn", "role", "text", "n_quoted", "n_linked", "parent_turn", F.col("head_turn").alias("branch"), "place"
    )


def _branches(edges: DataFrame) -> DataFrame:
    """(ck, seq, head_turn, place) by pointer doubling along branches.

    A message points to its parent if it is the first to answer it. Each round
    doubles what a pointer spans, so the rounds grow with the logarithm of the
    longest branch, and only messages that have not reached their head take part
    in the next one. What a pointer leads to carries the head's turn along, so keys
    are single messages: nothing is hot.
    """
    firsts = edges.where("parent IS NOT NULL").groupBy("ck", "parent").agg(F.min("seq").alias("seq"))
    goes_on = firsts.select("ck", "seq", F.lit(True).alias("goes_on"))
    state = materialise(
        edges.join(goes_on, ["ck", "seq"], "left").select(
            "ck",
            "seq",
            F.when(F.col("goes_on"), F.col("parent")).otherwise(F.col("seq")).alias("head"),
            F.col("turn").alias("head_turn"),
            F.when(F.col("goes_on"), 1).otherwise(0).cast("long").alias("place"),
        ),
        "quote-branches",
    )
    closed, still_open = state.where("place = 0"), state.where("place > 0")
    while still_open.limit(1).count():
        # where a pointer's target points to, and whether that is the head for good
        targets = closed.withColumn("final", F.lit(True)).unionByName(still_open.withColumn("final", F.lit(False)))
        ahead = targets.select(
            "ck",
            F.col("seq").alias("head"),
            F.col("head").alias("next"),
            F.col("head_turn").alias("next_turn"),
            F.col("place").alias("more"),
            "final",
        )
        moved = materialise(
            still_open.join(ahead, ["ck", "head"]).select(
                "ck",
                "seq",
                F.col("next").alias("head"),
                F.col("next_turn").alias("head_turn"),
                (F.col("place") + F.col("more")).alias("place"),
                "final",
            ),
            "quote-branches",
        )
        closed = closed.unionByName(moved.where("final").drop("final"))
        still_open = moved.where("NOT final").drop("final")
    return closed.select("ck", "seq", "head_turn", "place")
