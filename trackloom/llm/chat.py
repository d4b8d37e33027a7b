r"""Chat formatting by prefix-target expansion, in DataFrame operations alone.

Every assistant turn becomes an example: the conversation up to it, with that reply as the only text under the loss mask.
Turns after the last reply close the conversation in an example without a mask, so that the examples hold all turns.

Template of a turn: "### role: text</turn>\n". Inside roles and texts a backslash is written \\, # is \h and < is \l (and in roles
: is \c), so none of the template's control strings can occur in them, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE, AFTER_ROLE = "### ", "</turn>\n", ": "


def escaped(text: Column, role: bool = False) -> Column:
    for plain, code in [("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"), *([(":", "\\c")] if role else [])]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """The inverse: what lies between doubled backslashes is decoded, then those become one backslash each."""

    def decode(part: Column) -> Column:
        for plain, code in (("#", "\\h"), ("<", "\\l"), (":", "\\c")):
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), decode), "\\")


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (1, 2, ...), formatted, loss_start, loss_end (code points; equal where nothing is trainable).

    Turns are ordered by turn, then role and text where turns tie; rows that repeat are turns that repeat. Null texts and
    roles are empty; rows with a null conv_id are one conversation. Other columns are not read.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    written = whole.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == "assistant").alias("replies"),
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), escaped(t["role"], True), F.lit(AFTER_ROLE))).alias("heads"),
        F.transform("turns", lambda t: escaped(t["text"])).alias("texts"),
    )
    written = written.withColumn("all", F.zip_with("heads", "texts", lambda h, t: F.concat(h, t, F.lit(CLOSE))))
    ends = F.filter(F.sequence(F.lit(1), F.size("all")), lambda i: F.element_at("replies", i) | (i == F.size("all")))
    each = written.select("*", F.posexplode(ends).alias("example", "last"))
    before = F.array_join(F.slice("all", F.lit(1), F.col("last") - 1), "")
    start = F.length(before) + F.length(F.element_at("heads", F.col("last")))
    each = each.select("conv_id", (F.col("example") + 1).cast("long").alias("example"), F.array_join(F.slice("all", F.lit(1), F.col("last")), "").alias("formatted"), start.cast("long").alias("loss_start"), F.when(F.element_at("replies", F.col("last")), F.length(F.element_at("texts", F.col("last")))).otherwise(0).alias("loss"))
    return each.select("conv_id", "example", "formatted", "loss_start", (F.col("loss_start") + F.col("loss")).alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the examples say of each conversation: its turns from the longest one, its trainable text from all masks."""
    loss = F.substring(F.col("formatted"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    per = formatted.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", loss.alias("loss")))).alias("losses"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    turns = F.slice(F.split("whole", CLOSE), F.lit(1), F.size(F.split("whole", CLOSE)) - 1)
    per = per.withColumn("turns", turns).withColumn("loss", F.array_join(F.transform("losses", lambda x: unescaped(x["loss"])), ""))

    def turn(t: Column) -> Column:
        at = F.instr(t, AFTER_ROLE)
        role, text = F.substring(t, F.lit(len(OPEN) + 1), at - len(OPEN) - 1), F.substring(t, at + len(AFTER_ROLE), F.length(t))
        return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    said = F.array_join(F.transform("turns", turn), "")
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars")


def with_probe(conversations: DataFrame) -> DataFrame:
    """conversations and one, -7, whose texts hold the template's own control strings."""
    spark: SparkSession = conversations.sparkSession
    says = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
