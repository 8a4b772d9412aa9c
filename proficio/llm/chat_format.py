"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users; the loss mask covers
the assistant's messages only.  A dialogue is rendered in parts of
``turns_per_part`` consecutive turn numbers.  Turn numbers may repeat or be
null, so a part can hold any share of all rows: one whose messages weigh more
than ``piece_size`` is rendered in pieces, one row each, so no row holds it
all.  Pieces are cut by position: the weights of the messages before, from
ranges of the sorted messages and an offset per range; the tables of full
parts and offsets grow with the data, so how they are joined is left to the
planner.  Joined in order, the pieces' texts are the part's text.  Messages meet the speakers by an ordinary
join on conv_id, where a large conversation is split only as far as the
planner broadcasts the speakers or splits skewed joins.

Defined cases: a null text is an empty message; a null role speaks as
``unknown``; a null conv_id is a conversation of its own; a null turn comes
first, as part -1; messages of one turn are ordered by role and text; rows
repeated in all four columns are counted and rendered that many times;
``system`` messages keep their role and nobody takes their perspective, so a
conversation of system messages alone has no rows.  ``<|`` in a message or
name is written ``< |`` so that no message can forge a marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proficio.llm._util import shuffle_partitions
from proficio.session import materialize

TURNS_PER_PART = 64
PIECE_SIZE = 8 << 20       # code points, with MESSAGE_SIZE for every message
MESSAGE_SIZE = 512
SYSTEM = "system"


def _plain(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def _pieces(said: DataFrame, messages: DataFrame, piece_size: int) -> DataFrame:
    """``messages`` with their piece of the part; copies of one message may go on in the next pieces."""
    weight = F.length("role") + F.length("text") + F.lit(MESSAGE_SIZE).cast("bigint")
    full = materialize(said.groupBy(F.col("conv_id").alias("f_conv"), F.col("part").alias("f_part"))
                       .agg(F.sum(weight).alias("size")).where(F.col("size") > piece_size).drop("size"),
                       "chat-full-parts")
    whole = messages.withColumn("piece", F.lit(0).cast("bigint"))
    if full.isEmpty():
        return whole
    is_full = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("part") == F.col("f_part"))
    order = ["turn", "role", "text"]
    ranged = materialize(messages.join(full, is_full, "left_semi").withColumn("w", weight)
                         .repartitionByRange(shuffle_partitions(said.sparkSession), "conv_id", "part", *order)
                         .withColumn("range", F.spark_partition_id()), "chat-ranges")
    size = F.sum(F.col("n") * F.col("w"))
    ranges = Window.partitionBy("r_conv", "r_part").orderBy("r_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(F.col("conv_id").alias("r_conv"), F.col("part").alias("r_part"),
                              F.col("range").alias("r_range")).agg(size.alias("size"))
               .select("r_conv", "r_part", "r_range", F.coalesce(F.sum("size").over(ranges), F.lit(0)).alias("offset")))
    inside = (Window.partitionBy("conv_id", "part", "range").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    at = (ranged.withColumn("inside", F.coalesce(size.over(inside), F.lit(0)))
          .join(offsets, F.col("conv_id").eqNullSafe(F.col("r_conv"))
                & (F.col("part") == F.col("r_part")) & (F.col("range") == F.col("r_range")))
          .withColumn("at", F.col("inside") + F.col("offset")))
    # copy j begins at + j * w; a piece has the copies that begin in it
    cut = at.select("*", F.explode(F.expr(f"sequence(at div {piece_size}, (at + (n - 1) * w) div {piece_size})"))
                    .alias("piece"))
    before = "greatest(0, least(n, ({} * {} - at + w - 1) div w))"
    copies = F.expr(f"{before.format('(piece + 1)', piece_size)} - {before.format('piece', piece_size)}")
    return (whole.join(full, is_full, "left_anti")
            .unionByName(cut.withColumn("n", copies).where("n > 0").select(whole.columns)))


def rotate(conversations: DataFrame, system_role: str = SYSTEM,
           turns_per_part: int = TURNS_PER_PART, piece_size: int = PIECE_SIZE) -> DataFrame:
    """One row per (perspective, distinct message, piece): conv_id, perspective, part, piece, turn, role, text,
    n, segment, masked; masked segments are the perspective's own."""
    said = (conversations
            .select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("part", F.coalesce(F.floor(F.col("turn") / turns_per_part), F.lit(-1)).cast("bigint")))
    messages = _pieces(said, said.groupBy("conv_id", "part", "turn", "role", "text").agg(F.count("*").alias("n")),
                       piece_size)
    speakers = (conversations
                .select(F.col("conv_id").alias("s_conv"),
                        F.coalesce("role", F.lit("unknown")).alias("perspective"))
                .where(F.col("perspective") != system_role).distinct())
    seen = messages.join(speakers, messages.conv_id.eqNullSafe(speakers.s_conv)).drop("s_conv")
    masked = F.col("role") == F.col("perspective")
    header = (F.when(F.col("role") == system_role, F.lit("system"))
              .when(masked, F.lit("assistant"))
              .otherwise(F.concat(F.lit("user name="), _plain(F.col("role")))))
    segment = F.concat(F.lit("<|im_start|>"), header, F.lit("\n"), _plain(F.col("text")), F.lit("<|im_end|>\n"))
    return seen.withColumn("segment", segment).withColumn("masked", masked)


def chat_views(conversations: DataFrame, system_role: str = SYSTEM,
               turns_per_part: int = TURNS_PER_PART, piece_size: int = PIECE_SIZE) -> DataFrame:
    """conv_id, perspective, part, piece, n_messages, rendered, mask_spans, n_masked_chars.

    ``piece`` is 0 but in a part that weighs more than ``piece_size``.
    ``mask_spans`` lists ``start:length`` (code points within the row's text)
    of every assistant message with its end marker, the header left out.
    """
    rows = rotate(conversations, system_role, turns_per_part, piece_size)
    parts = (rows.groupBy("conv_id", "perspective", "part", "piece")
             .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "n", "segment", "masked"))).alias("m")))
    # array_sort puts null turns anywhere only within part -1, where all are null
    copies = F.flatten(F.transform("m", lambda x: F.array_repeat(F.struct(x.segment.alias("segment"),
                                                                          x.masked.alias("masked")),
                                                                 x.n.cast("int"))))
    head = len("<|im_start|>assistant\n")
    spans = F.expr(f"""
        aggregate(all_m, named_struct('at', 0, 'spans', cast(array() as array<string>)),
                  (s, x) -> named_struct('at', s.at + length(x.segment),
                      'spans', if(x.masked, array_append(s.spans, concat(s.at + {head}, ':',
                                  length(x.segment) - {head})), s.spans)),
                  s -> s.spans)""")
    masked_chars = F.expr(f"aggregate(all_m, 0L, (s, x) -> s + if(x.masked, length(x.segment) - {head}, 0))")
    return (parts.withColumn("all_m", copies)
            .select("conv_id", "perspective", "part", "piece", F.size("all_m").cast("bigint").alias("n_messages"),
                    F.array_join(F.transform("all_m", lambda x: x.segment), "").alias("rendered"),
                    F.array_join(spans, ",").alias("mask_spans"), masked_chars.alias("n_masked_chars")))
