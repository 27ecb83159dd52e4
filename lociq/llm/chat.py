"""Chat formatting: the dialogue as each of its participants would have it.

DataFrame functions only. For every participant of a conversation the dialogue is rendered
with that speaker as the assistant, system turns as they are, and all others as users with
their names; a mask tells which characters the participant said.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns that are rendered together before a dialogue is joined up from its parts; the result doesn't depend on it.
PART_TURNS = 256
#: A turn is OPEN, its heading, BODY, its text, CLOSE.
OPEN, BODY, CLOSE = "<|turn|>", "\n", "<|end|>\n"
SYSTEM, UNNAMED = "system", "unnamed"


def heading(perspective: Column, speaker: Column) -> Column:
    return F.when(speaker == perspective, F.lit("assistant")).when(speaker == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), speaker))


def rotate(turns: DataFrame, *, conversation: str = "conv_id", order: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """A row for each conversation and participant.

    Columns: conv_id, perspective, first_turn, last_turn, n_turns, n_own, rendered,
    mask_starts, mask_ends (spans of the participant's own texts and their CLOSE, in
    characters), own_chars.

    Participants are the distinct speakers but ``system``; a conversation with system turns
    alone has no row. A null speaker is named ``unnamed``, a null text is empty. Turns go by
    their number, a null number as -1; turns with the same number by speaker, then text, and
    repeated rows stay. Rows of a null conversation are one conversation.

    The turns move once, to the task of their conversation, where a spilling sort puts them in
    order and parts of PART_TURNS are rendered and joined up. A result row holds a whole
    dialogue, so a dialogue has to fit into a value of Spark's, which is two gigabytes.
    """
    t = turns.select(
        F.col(conversation).alias("conv_id"), F.coalesce(F.col(order).cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(speaker), F.lit(UNNAMED)).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    placed = t.withColumn("k", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "speaker", "text")))
    parts = placed.groupBy("conv_id", F.floor((F.col("k") - 1) / PART_TURNS).alias("part")).agg(F.array_sort(F.collect_list(F.struct("k", "turn", "speaker", "text"))).alias("said"))
    people = t.filter(F.col("speaker") != SYSTEM).groupBy("conv_id").agg(F.collect_set("speaker").alias("people")).withColumnRenamed("conv_id", "of")
    views = parts.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "part", "said", F.explode("people").alias("perspective"))
    views = views.withColumn("heads", F.transform("said", lambda x: F.concat(F.lit(OPEN), heading(F.col("perspective"), x["speaker"]), F.lit(BODY))))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["heads"])
        end = start + F.length(x["said"]["text"]) + len(CLOSE)
        mine = F.array(F.struct(start.alias("s"), end.alias("e")))
        return F.struct(end.alias("at"), F.when(x["said"]["speaker"] == F.col("perspective"), F.concat(acc["own"], mine)).otherwise(acc["own"]).alias("own"))

    nothing = lambda: F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("own"))
    views = views.withColumn("spans", F.aggregate(F.arrays_zip("said", "heads"), nothing(), add))
    whole = views.groupBy("conv_id", "perspective").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "part", F.col("said")[0]["turn"].alias("first"), F.element_at("said", -1)["turn"].alias("last"), F.size("said").alias("n"), F.col("spans.at").alias("length"), F.col("spans.own").alias("own"),
                    F.array_join(F.zip_with("heads", "said", lambda h, x: F.concat(h, x["text"], F.lit(CLOSE))), "").alias("rendered"),
                )
            )
        ).alias("parts")
    )

    def join_up(acc: Column, x: Column) -> Column:
        moved = F.transform(x["own"], lambda o: F.struct((o["s"] + acc["at"]).alias("s"), (o["e"] + acc["at"]).alias("e")))
        return F.struct((acc["at"] + x["length"]).alias("at"), F.concat(acc["own"], moved).alias("own"))

    whole = whole.withColumn("own", F.aggregate("parts", nothing(), join_up, lambda acc: acc["own"]))
    sums = lambda arr, value: F.aggregate(arr, F.lit(0).cast("long"), lambda a, x: a + value(x))
    return whole.select(
        "conv_id",
        "perspective",
        F.col("parts")[0]["first"].alias("first_turn"),
        F.element_at("parts", -1)["last"].alias("last_turn"),
        sums("parts", lambda x: x["n"]).alias("n_turns"),
        F.size("own").cast("long").alias("n_own"),
        F.array_join("parts.rendered", "").alias("rendered"),
        F.col("own.s").alias("mask_starts"),
        F.col("own.e").alias("mask_ends"),
        sums("own", lambda x: x["e"] - x["s"] - len(CLOSE)).alias("own_chars"),
    )
