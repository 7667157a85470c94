"""Chat formatting by multi-party perspective rotation (DataFrame operations only).

Method. Every participant of a conversation (each role but ``system``) in turn is the assistant: the whole
dialogue is rendered with that speaker's turns under ``assistant``, the others' under ``user`` with their
name, system turns under ``system``; the mask names the character ranges of the speaker's own words, which a
model is trained on. A dialogue is one text per speaker. It is returned in parts of at most ``PART`` turns by position, which joined in
order are that text: ``start`` is a part's first character in it, and masks count from the beginning of the dialogue.

Turns are numbered by position without gathering a conversation: one range-partitioned sort by (conversation, turn, role, text), written
once, in which equal rows may part anywhere; the rows before each partition (a number per partition) are literals of
the plan. A conversation's first number reaches its rows by blocks of ``BLOCK`` numbers, so one that holds a third of
all rows meets it in many tasks. Offsets are prefix sums in two levels: parts within ``GROUP`` parts, and those groups.

What a participant says cannot forge the template: ``<|`` in a name or a text becomes ``<\\|``, and ``<\\`` becomes ``<\\\\`` (undone by the
reverse replacements); a line end in a name becomes a space.

Defined results: a null text is empty, a null role is the participant ``unknown``; null turns come last; null conversation ids form one
conversation; equal turns are ordered by role and text, repeated rows are rendered each;
a conversation of system turns alone has no participant and no row. A very long text stays whole in its part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

#: turns of a part, row numbers of a block, parts of a group
PART, BLOCK, GROUP = 64, 1 << 16, 4096
# fixed values: the template's markers
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_LAST = (1 << 63) - 1
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below
#: partitions of the sort whose row counts become literals
MAX_PARTITIONS = 10_000


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, no_conv, role, text, n: the turns of all conversations numbered 0, 1, ... in order, conversation by conversation."""
    spark = conversations.sparkSession
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
        F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_LAST)).alias("turn"),
        F.col("turn").isNull().alias("no_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("any"),  # equal rows may lie in several partitions
    )
    order = ["no_conv", "conv_id", "no_turn", "turn", "role", "text", "any"]
    parts = min(MAX_PARTITIONS, tb.shuffle_tasks(spark))
    laid = turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    laid = tb.materialized(laid.drop("any", "turn", "no_turn"), "turns")
    partition = F.shiftright(F.col("at"), _ROW_BITS)
    sizes = sorted(tuple(r) for r in laid.groupBy(partition.alias("p")).agg(F.count("*").alias("n")).collect())
    before, so_far = [], 0
    for p, n in sizes:
        before.append(F.struct(F.lit(p).cast("long").alias("p"), F.lit(so_far).cast("long").alias("n")))
        so_far += n
    if not before:
        return laid.withColumnRenamed("at", "n")
    earlier = F.map_from_entries(F.array(*before))[partition]
    return laid.select("conv_id", "no_conv", "role", "text", (earlier + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).alias("n"))


def _positions(turns: DataFrame) -> DataFrame:
    """``turns`` with their position in the conversation."""
    key = ["no_conv", "conv_id"]
    spans = turns.groupBy(*key).agg(F.min("n").alias("first"), F.max("n").alias("last"))
    block = lambda c: F.floor(F.col(c) / BLOCK)
    spans = spans.select(*key, "first", F.explode(F.sequence(block("first"), block("last"))).alias("block"))
    return turns.withColumn("block", block("n")).join(spans, [*key, "block"]).withColumn("position", F.col("n") - F.col("first")).drop("block", "first", "n")


def perspectives(conversations: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, speaker, part, start, n_turns, rendered, mask (``start:end`` of the speaker's words in the whole dialogue, comma-joined)."""
    key = ["no_conv", "conv_id"]
    turns = _positions(numbered(conversations)).withColumn("part", F.floor(F.col("position") / part))
    turn = F.struct("position", "role", escaped(F.translate("role", "\n", " ")).alias("name"), escaped(F.col("text")).alias("text"))
    parts = turns.groupBy(*key, "part").agg(F.sort_array(F.collect_list(turn)).alias("ts"))
    parts = tb.materialized(parts.withColumn("group", F.floor(F.col("part") / GROUP)), "dialogue-parts")
    # every participant meets every part of the conversation, group by group
    groups = parts.select(*key, "group").distinct()
    speakers = turns.where("role <> 'system'").select(*key, F.col("role").alias("speaker")).distinct().join(groups, key)
    seen = parts.join(speakers, [*key, "group"])
    head = lambda t: F.when(t["role"] == F.col("speaker"), F.lit(f"{OPEN}assistant\n")).when(t["role"] == "system", F.lit(f"{OPEN}system\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), t["name"], F.lit("\n")))
    shown = F.transform("ts", lambda t: F.struct((t["role"] == F.col("speaker")).alias("own"), F.length(head(t)).alias("head"), F.length(t["text"]).alias("words"), F.concat(head(t), t["text"], F.lit(CLOSE)).alias("shown")))
    said = seen.select(*key, "speaker", "group", "part", shown.alias("ts")).withColumn("rendered", F.array_join(F.transform("ts", lambda t: t["shown"]), ""))
    # offsets: groups before, parts before in the group
    size = F.length("rendered").cast("long")
    inside = Window.partitionBy(*key, "speaker", "group").orderBy("part")
    said = said.withColumns({"before": F.sum(size).over(inside) - size, "size": size})
    totals = said.groupBy(*key, "speaker", "group").agg(F.sum("size").alias("total"))
    totals = totals.withColumn("base", F.sum("total").over(Window.partitionBy(*key, "speaker").orderBy("group")) - F.col("total"))
    placed = said.join(totals.drop("total"), [*key, "speaker", "group"]).withColumn("start", F.col("base") + F.col("before"))
    # at most `part` turns: their running offsets by prefix slices
    sizes = F.transform("ts", lambda t: t["head"] + t["words"] + len(CLOSE))
    offset = lambda i: F.aggregate(F.slice("sizes", F.lit(1), i), F.col("start"), lambda a, n: a + n)
    span = lambda t, i: F.concat((offset(i) + t["head"]).cast("string"), F.lit(":"), (offset(i) + t["head"] + t["words"]).cast("string"))
    marked = F.filter(F.transform(F.col("ts"), lambda t, i: F.when(t["own"], span(t, i))), lambda s: s.isNotNull())
    return placed.withColumn("sizes", sizes).select(
        F.when(~F.col("no_conv"), F.col("conv_id")).alias("conv_id"),
        "speaker",
        F.col("part").cast("long").alias("part"),
        "start",
        F.size("ts").cast("long").alias("n_turns"),
        "rendered",
        F.array_join(marked, ",").alias("mask"),
    )
