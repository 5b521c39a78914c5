"""Prompts for a text classifier and the parsing of its replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.texts import strip

PROMPT_TEMPLATE = """Decide whether a document is written mainly in {language}.

The text below was read from the document's pages and may hold recognition errors.

<ocr_output>
{text}
</ocr_output>

Single foreign terms, citations and references do not matter. Answer false when whole paragraphs or sections are in
another language.

Reply with JSON: first a "reasoning" string, then "answer", true when the document is suitable and false when not.
"""


def build_prompt(text: Column, language: str = "Indonesian", template: str = PROMPT_TEMPLATE) -> Column:
    """Put the text, all of it, into the template. `pieces` cuts what is too long for one call."""
    before, after = template.replace("{language}", language).split("{text}")
    return F.concat(F.lit(before), text, F.lit(after))


def pieces(text: Column, length: int) -> Column:
    """The text cut into parts of `length` code points, the last one shorter; none for an empty text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{length}}}"), F.lit(0))


def extract_tagged(text: Column, tag: str = "output") -> Column:
    """What the first <tag>...</tag> holds, stripped; the text itself when there is none."""
    pattern = rf"(?s)<{tag}>(.*?)</{tag}>"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1))).otherwise(text)


def parse_reply(reply: Column) -> Column:
    """The boolean under "answer" of a JSON reply.

    Not JSON: true when the reply mentions "true". No reply, no object or no such key: false. An answer that is not a
    boolean: null. Of repeated keys the last counts.
    """

    def kind(value: Column, path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(value, path, "variant"))

    # The JSON readers stop after the first value. What follows it can pass for the end of a list or of an object, but not
    # of both, and not without a second element: so a reply is JSON if it is the only element of the one and fits the other.
    listed, inner = F.concat(F.lit("["), reply, F.lit("]")), F.concat(F.lit('{"v":'), reply, F.lit("}"))
    value = F.try_parse_json(listed)
    is_json = kind(value, "$[0]").isNotNull() & kind(value, "$[1]").isNull() & F.try_parse_json(inner).isNotNull()
    # That reader refuses repeated keys. This one takes the last of them.
    strict = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
    one = F.from_json(inner, "v struct<answer: variant>", strict)["v"]
    repeated = one.isNotNull() & (F.size(F.from_json(listed, "array<struct<answer: variant>>", strict)) == 1)
    has_answer = F.array_contains(F.json_object_keys(reply), "answer")
    return (
        F.when(reply.isNull(), F.lit(False))
        .when(
            is_json,
            F.when(~F.startswith(kind(value, "$[0]"), F.lit("OBJECT")) | kind(value, "$[0].answer").isNull(), F.lit(False)).when(
                kind(value, "$[0].answer") == "BOOLEAN", F.try_variant_get(value, "$[0].answer", "boolean")
            ),
        )
        .when(
            repeated,
            F.when(~has_answer, F.lit(False)).when(
                F.schema_of_variant(one["answer"]) == "BOOLEAN", F.try_variant_get(one["answer"], "$", "boolean")
            ),
        )
        .otherwise(F.contains(F.lower(reply), F.lit("true")))
    )
