"""Chat rendering with perspective rotation (DataFrame functions only).

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant and all others as named users, as one row per
turn: the rendered segment, its place in the rendering, and the span that a
loss should count. The segments of a (conversation, perspective) in order are
the rendering; a conversation of any length is never put together in one
task: turns are dealt by range of (conversation, turn, speaker, text), and the
places of a conversation's earlier ranges are added to those within a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldvein.llm.common import written

END = "<|end|>\n"


def _same(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[f"_{k}"])
    return out


def _hidden(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"_{k}" for k in keys})


def rotate_perspectives(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", context_roles: tuple[str, ...] = ("system",)) -> DataFrame:
    """conv_id, perspective, position, turn, speaker, chat_role, segment,
    start, length, loss_start, loss_end per (perspective, turn).

    ``position`` counts from 0 by (turn, speaker, text), null turns first, so
    ties have one order and repeated rows follow each other. Offsets are code
    points of the rendering. ``loss_start`` and ``loss_end`` span text and end
    mark of the perspective's own turns and are null elsewhere. Speakers
    named in ``context_roles`` open as ``system`` in every rendering and are no
    perspective; a conversation of such turns alone gives no rows. A null role
    is the speaker ``unknown``, a null text is empty, null conversation ids form
    one conversation. ``<|`` within texts or names becomes ``<\\|`` so that no
    text can forge a mark. An empty table gives an empty result; other columns
    are ignored.
    """
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("<\\|"))
    speaker = clean(F.coalesce(F.nullif(F.trim(F.col(f"`{role}`").cast("string")), F.lit("")), F.lit("unknown")))
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), speaker.alias("speaker"),
        clean(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("t"))
    # Equal rows are told apart by where they were read, so that they too spread over ranges. Written once:
    # every use below must see the same ranges.
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, "conv_id", "turn", "speaker", "t", "tie")
    rows = written(rows.withColumn("bucket", F.spark_partition_id()).drop("tie"), "turns")
    context = F.col("speaker").isin(*context_roles) if context_roles else F.lit(False)
    views = _hidden(rows.where(~context).select("conv_id", F.col("speaker").alias("perspective")).distinct(), "conv_id")

    def rendered(df: DataFrame, *keep: str) -> DataFrame:
        """One row per perspective and turn; ``keep`` of the text columns."""
        df = df.join(views, _same(df, views, "conv_id")).drop("_conv_id")
        own = F.col("speaker") == F.col("perspective")
        chat_role = F.when(context, "system").when(own, "assistant").otherwise("user")
        head = F.when(context, "<|system|>\n").when(own, "<|assistant|>\n").otherwise(
            F.concat(F.lit("<|user name="), F.col("speaker"), F.lit("|>\n")))
        return df.select("conv_id", "perspective", "turn", "bucket", "speaker", *keep, chat_role.alias("chat_role"), head.alias("head"),
                         (F.char_length(head) + F.col("n") + len(END)).cast("long").alias("length"))

    sized = rows.withColumn("n", F.char_length("t"))
    group = ["conv_id", "perspective"]
    totals = rendered(sized.drop("t")).groupBy(*group, "bucket").agg(
        F.sum("length").alias("chars"), F.count(F.lit(1)).alias("turns"))
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = _hidden(totals.select(*group, "bucket", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
                                   F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before")), *group, "bucket")
    within = Window.partitionBy(*group, "bucket").orderBy("turn", "speaker", "t")
    sums = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rendered(sized, "t").select("*", F.row_number().over(within).alias("nth"), F.sum("length").over(sums).alias("end"))
    out = out.join(totals, _same(out, totals, *group, "bucket"))
    start = F.col("chars_before") + F.col("end") - F.col("length")
    own = F.col("chat_role") == "assistant"
    return out.select(
        "conv_id", "perspective", (F.col("turns_before") + F.col("nth") - 1).cast("long").alias("position"), "turn", "speaker", "chat_role",
        F.concat("head", "t", F.lit(END)).alias("segment"), start.cast("long").alias("start"), "length",
        F.when(own, start + F.char_length("head")).cast("long").alias("loss_start"),
        F.when(own, start + F.col("length")).cast("long").alias("loss_end"))
