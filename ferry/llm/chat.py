"""Chat formatting into token-budgeted windows of whole turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed marks of the template: [INST]role[/INST]text</s> for each turn.
OPEN, ROLE_END, CLOSE = "[INST]", "[/INST]", "</s>"
#: Strings that a text may not hold as they are.
CONTROL = ("<s>", CLOSE, OPEN, ROLE_END, "<<SYS>>", "<</SYS>>")
#: Turns of a conversation whose tokens are summed in one step.
BLOCK = 256


def escaped(text: Column) -> Column:
    """``text`` with a backslash after the first character of each control string, and
    each backslash doubled."""
    marks = "|".join(r"\Q%s\E" % c[1:] for c in sorted(CONTROL, key=len, reverse=True))
    firsts = "".join(sorted({c[0] for c in CONTROL})).replace("[", r"\[")
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([{firsts}])(?={marks})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def tokens(text: Column) -> Column:
    """An estimate of a text's tokens: runs of letters or digits and single other marks."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"))


def placed(turns: DataFrame, overhead: int) -> DataFrame:
    """``turns`` with ``idx`` and ``before``: turns and tokens of the conversation before
    each. Sums run within blocks of turn numbers, then over the blocks' totals, so no task
    holds all turns of a conversation."""
    rows = turns.withColumn("n", F.coalesce(tokens(F.col("text")), F.lit(0)) + F.lit(overhead)).withColumn(
        "block", F.floor(F.col("turn") / BLOCK))
    own = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumn("i", F.row_number().over(own) - 1).withColumn(
        "s", F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    blocks = rows.groupBy("conv_id", "block").agg(F.count("*").alias("bi"), F.sum("n").alias("bs"))
    past = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("bi").over(past), F.lit(0)).alias("bi"),
                           F.coalesce(F.sum("bs").over(past), F.lit(0)).alias("bs"))
    same = rows.alias("r").join(blocks.alias("b"), F.col("r.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("r.block").eqNullSafe(F.col("b.block")))
    return same.select("r.conv_id", "r.turn", "r.role", "r.text", "r.n", (F.col("i") + F.col("bi")).alias("idx"), (F.col("s") + F.col("bs")).alias("before"))


def windows(conversations: DataFrame, budget: int = 2048, history: int = 256, overhead: int = 4,
            target_role: str = "assistant") -> DataFrame:
    """(conv_id, window, formatted, loss_spans, n_turns, n_repeated, n_tokens,
    over_budget): conversations as training texts.

    Rows are turns: conv_id, turn, role, text. They are ordered by turn, then role and
    text, so equal turn numbers and repeated rows all stay, in a fixed order. Null roles
    and texts count as empty; a null turn comes first; turns of a null conv_id are one
    conversation. Columns beside these are ignored. An empty table gives none.

    Prefix sums of turn tokens choose the windows: turns that start in the same step of
    tokens are new in the same window, where a step is half of what the budget leaves
    beside the system turn and the history; a turn longer than a step has its own window.
    Each window begins with the conversation's system turn (its first row, if its role is
    ``system``), then repeats the turns that start in the last ``history`` tokens before
    its first new turn. ``loss_spans`` are code points [start, end) of the texts of new
    turns of ``target_role``: repeated ones and other roles are masked. Windows hold at
    most ``budget`` tokens unless the system turn and one turn alone exceed it
    (``over_budget``).

    A turn is ``[INST]role[/INST]text</s>``, with control strings inside escaped
    reversibly (see ``turns_of``).
    """
    if overhead < 1:
        raise ValueError("a turn costs at least one token")
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = placed(turns, overhead)
    system = rows.where("idx = 0 and role = 'system'").select(F.col("conv_id").alias("sc"), F.col("text").alias("system"), F.col("n").alias("sn"))
    rows = rows.join(system, F.col("conv_id").eqNullSafe(F.col("sc")), "left").withColumn("sn", F.coalesce("sn", F.lit(0)))
    step = F.greatest(F.floor((F.lit(budget - history) - F.col("sn")) / 2), F.lit(max(1, budget // 16)))
    head = (F.col("idx") == 0) & F.col("system").isNotNull()
    rows = rows.withColumn("step", step).withColumn("before", F.when(head, 0).otherwise(F.col("before") - F.col("sn")))
    rows = rows.withColumn("bucket", F.floor(F.col("before") / F.col("step"))).withColumn("alone", (F.col("n") > F.col("step")).cast("int"))
    # a conversation of a system turn alone still has its window
    new = rows.where(~head)
    lone = rows.where(head).select("conv_id", F.lit(0).alias("bucket"), F.lit(0).alias("alone"), F.lit(0).alias("starts"))
    begins = new.select("conv_id", "bucket", "alone", F.col("before").alias("starts")).union(
        lone.join(new.select(F.col("conv_id").alias("nc")).distinct(), F.col("conv_id").eqNullSafe(F.col("nc")), "left_anti"))
    begins = begins.groupBy("conv_id", "bucket", "alone").agg(F.min("starts").alias("starts"))
    key = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    # each turn meets the windows of its own bucket and those that its tokens may reach back from
    offered = new.withColumn("seen", F.explode(F.sequence("bucket", F.floor((F.col("before") + history) / F.col("step")))))
    o, b = offered.alias("o"), begins.alias("b")
    met = o.join(b, key("o", "b") & (F.col("o.seen") == F.col("b.bucket")))
    fresh = (F.col("o.bucket") == F.col("b.bucket")) & (F.col("o.alone") == F.col("b.alone"))
    past = (F.col("o.before") < F.col("b.starts")) & (F.col("o.before") >= F.col("b.starts") - history)
    inside = met.where(fresh | past).select("o.conv_id", "b.bucket", "b.alone", fresh.alias("fresh"), "o.idx", "o.role", "o.text", "o.n")
    r = rows.where(head).alias("r")
    heads = r.join(b, key("r", "b")).select("r.conv_id", "b.bucket", "b.alone", ((F.col("b.bucket") == 0) & (F.col("b.starts") == 0)).alias("fresh"),
                                            "r.idx", "r.role", "r.text", "r.n")
    turn = F.struct("idx", "fresh", (F.col("fresh") & (F.col("role") == target_role)).alias("target"), "n",
                    F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(ROLE_END)).alias("lead"), escaped(F.col("text")).alias("body"))
    packed = inside.union(heads).groupBy("conv_id", "bucket", "alone").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["lead"], t["body"], F.lit(CLOSE))), "")
    ends = F.aggregate("turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")), lambda a, t: F.struct(
        (a["at"] + F.length(t["lead"]) + F.length(t["body"]) + F.lit(len(CLOSE))).alias("at"),
        F.when(t["target"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["lead"])).alias("start"), (a["at"] + F.length(t["lead"]) + F.length(t["body"])).alias("end")))))
        .otherwise(a["spans"]).alias("spans")))
    n_tokens = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["n"])
    return packed.select("conv_id", (F.col("bucket") * 2 + F.col("alone")).cast("long").alias("window"), formatted.alias("formatted"),
                         ends["spans"].alias("loss_spans"), F.size("turns").cast("long").alias("n_turns"),
                         F.size(F.filter("turns", lambda t: ~t["fresh"])).cast("long").alias("n_repeated"),
                         n_tokens.alias("n_tokens"), (n_tokens > budget).alias("over_budget"))


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted window, read back: array of (role, text)."""
    parts = F.split(formatted, r"\Q%s\E" % CLOSE)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(parts, lambda p: F.struct(
        unescaped(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ROLE_END, 1)).alias("role"),
        unescaped(F.substr(p, F.instr(p, ROLE_END) + F.lit(len(ROLE_END)))).alias("text")))


def digests(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows),
    read back from the formatted windows: the turns that no window repeats, in order, and
    all text under the loss spans, unescaped. One row per conversation."""
    fresh = F.slice(turns_of(F.col("formatted")), (F.col("n_repeated") + 1).cast("int"),
                    F.greatest((F.col("n_turns") - F.col("n_repeated")).cast("int"), F.lit(0)))
    spans = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    rows = windows.withColumn("new", fresh).select(
        "conv_id", "window", F.size("new").cast("long").alias("n"),
        F.array_join(F.transform("new", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        spans.alias("loss"), F.length("formatted").cast("long").alias("chars"))
    one = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"),
                                      F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    one = one.withColumn("turns", F.array_join("w.turns", "")).withColumn("loss", F.array_join("w.loss", ""))
    return one.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_windows")
