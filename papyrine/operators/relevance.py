"""Which documents are mainly in the wanted language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.functions.language import is_mainly_in
from papyrine.functions.replies import build_prompt, parse_reply, pieces
from papyrine.functions.sections import LONGEST, is_mainly_in_sections, language_sections
from papyrine.operators.hooks import Factory, append_result


def mark_by_language(df: DataFrame, target: str = "id", threshold: float = 0.8, text: str = "ocr_text") -> DataFrame:
    """Add `is_relevant` from function words, over the whole text. Rows with an `error` are not relevant."""
    relevant = is_mainly_in(F.col(text), target, threshold)
    if "error" in df.columns:
        relevant = F.when(F.col("error").isNull(), relevant).otherwise(F.lit(False))
    return df.withColumn("is_relevant", relevant)


def mark_by_sections(df: DataFrame, target: str = "id", threshold: float = 0.8, longest: int = LONGEST, text: str = "ocr_text") -> DataFrame:
    """Add `is_relevant`: enough of the text is in sections of the target language, and no foreign section is substantial.

    Foreign terms scattered over a text do no harm, as they make no section. Rows with an `error` are not relevant.
    """
    held = F.array(language_sections(F.col(text), target))  # found once
    relevant = F.element_at(F.transform(held, lambda sections: is_mainly_in_sections(sections, threshold, longest)), 1)
    if "error" in df.columns:
        relevant = F.when(F.col("error").isNull(), relevant).otherwise(F.lit(False))
    return df.withColumn("is_relevant", relevant)


def mark_by_classifier(
    df: DataFrame,
    classifier: Factory,
    language: str = "Indonesian",
    text: str = "ocr_text",
    piece_chars: int = 15_000,
    threshold: float = 0.8,
    batch_size: int = 64,
    **prompt: object,
) -> DataFrame:
    """Add `is_relevant` from the replies of a classifier the user brings.

    Every character is judged: a text is cut into pieces of `piece_chars`, each is asked about, and the text is relevant
    when pieces with at least `threshold` of its characters are. A call that fails counts as false; null when no reply held
    a boolean. Rows with an `error` or without a text are not sent, and are not relevant.

    `classifier()` is called once per task and returns a function from a list of at most `batch_size` prompts to replies.
    """
    cut = pieces(F.col(text), piece_chars)
    if "error" in df.columns:
        cut = F.when(F.col("error").isNull(), cut)
    asked = df.withColumn("_pieces", cut).withColumn(
        "_prompts", F.transform("_pieces", lambda piece: build_prompt(piece, language, **prompt))
    )
    replied = append_result(asked, classifier, "_prompts", "_replies", batch_size)
    judged = F.zip_with(
        "_pieces",
        "_replies",
        lambda piece, reply: F.struct(F.char_length(piece).cast("long").alias("chars"), parse_reply(reply["value"]).alias("answer")),
    )

    def add(total: Column, one: Column) -> Column:
        for_it = total["yes"] + F.when(one["answer"], one["chars"]).otherwise(0)
        known = total["known"] | one["answer"].isNotNull()
        return F.struct(for_it.alias("yes"), (total["all"] + one["chars"]).alias("all"), known.alias("known"))

    zero = F.lit(0).cast("long")
    nothing = F.struct(zero.alias("yes"), zero.alias("all"), F.lit(False).alias("known"))
    verdict = F.aggregate(judged, nothing, add, lambda total: F.when(total["known"], total["yes"] >= threshold * total["all"]))
    sent = F.coalesce(F.size("_pieces") > 0, F.lit(False))
    return replied.withColumn("is_relevant", F.when(sent, verdict).otherwise(F.lit(False))).drop("_pieces", "_prompts", "_replies")


def relevant_only(df: DataFrame) -> DataFrame:
    """Rows judged relevant; false and null both go."""
    return df.filter(F.col("is_relevant"))
