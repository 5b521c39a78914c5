"""The text of web pages, by a small parser made of expressions.

A page is cut into tags, comments and texts. One pass over the tags keeps the stack of open elements, so that it is known
where an element ends whatever its end tag looks like, and notes which stretches are in side elements. What stands in none
of them is the text; character references become characters at the end. All steps take linear time but for the depth of nesting.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.texts import SPACE, strip

# Elements that hold no article text, those that hold text only, and the others that are kept on the stack.
SIDE_ELEMENTS = ("script", "style", "noscript", "head", "nav", "header", "footer", "aside", "form")
RAW_ELEMENTS = ("script", "style")
CONTAINERS = ("body", "div", "section", "article", "main", "ul", "ol", "dl", "table", "tr", "td", "th", "figure", "fieldset", "blockquote", "details")
# Numbers of character references that stand for characters of Windows-1252, and those characters.
WINDOWS = dict(
    zip(
        [0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F],
        "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ",
        strict=True,
    )
)
UNKNOWN = "�"  # for numbers that are no character's

TEXT, OPEN, CLOSE = 0, 1, 2


def _token_pattern() -> str:
    """Comments, elements of text only, tags with and without an end, declarations, and texts.

    A tag ends at the first > outside quotes, or before the next < if there is none. One without an end is text if it follows
    a letter or digit, as in a<b; else it is left out.
    """
    quoted = r"""[^<>"']*+(?:(?:"[^"]*"|'[^']*')[^<>"']*+)*+"""
    raw = "|".join(RAW_ELEMENTS)
    return (
        rf"<!--(?s:.*?)(?:-->|\z)|<({raw})(?=[\s/>])[^>]*+(?:\z|>(?s:.*?)(?:</\1(?=[\s/>])[^>]*+(?:>|\z)|\z))"
        rf"|</?[a-zA-Z]{quoted}>|</?[a-zA-Z][^<>]*+>?|<[!?][^>]*+(?:>|\z)|</[^>]*+(?:>|\z)"
        r"|(?:[^<]++|<(?![a-zA-Z/!?])|(?<=[\p{L}\p{N}])<(?=/?[a-zA-Z])(?![^<>]*+>))++"
    )


_TOKEN = "(?i)" + _token_pattern()


def _tokens(html: Column, side: tuple[str, ...]) -> Column:
    """array<struct<at, kind, name, text>> of the texts and of the tags that matter."""

    def token(found: Column, place: Column) -> Column:
        tag = F.regexp_extract(found, r"^</?([a-zA-Z][^\s/>]*)", 1)
        name = F.lower(tag)
        kept = name.isin(*side, *CONTAINERS) & ~name.isin(*RAW_ELEMENTS)
        kind = (
            F.when(found.rlike(r"^<[!?]|^</(?![a-zA-Z])"), F.lit(None).cast("int"))
            .when(found.rlike(r"^<(?![a-zA-Z/])|^[^<]"), F.lit(TEXT))
            .when(kept & found.startswith("</"), F.lit(CLOSE))
            .when(kept, F.lit(OPEN))
        )
        return F.struct(place.alias("at"), kind.alias("kind"), name.alias("name"), found.alias("text"))

    return F.filter(F.transform(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), token), lambda one: one["kind"].isNotNull())


def _let(value: Column, body) -> Column:
    """`body` of `value`, which is found once."""
    return F.element_at(F.transform(F.array(value), body), 1)


_STATE = "struct<stack: array<string>, skip: int, start: int, ranges: array<struct<start: int, end: int>>>"


def _hidden_ranges(tags: Column, side: tuple[str, ...], end: Column) -> Column:
    """array<struct<start, end>>: stretches of tokens within side elements."""

    def step(state: Column, tag: Column) -> Column:
        opens = tag["kind"] == OPEN
        height = F.size(state["stack"])
        # A head without an end ends where the first element of the body begins.
        above = F.when(opens & (F.get(state["stack"], height - 1) == "head"), F.slice(state["stack"], 1, height - 1)).otherwise(state["stack"])

        def moved(stack: Column) -> Column:
            from_top = F.array_position(F.reverse(stack), tag["name"]).cast("int")
            closed = F.when(from_top > 0, F.slice(stack, 1, F.size(stack) - from_top)).otherwise(stack)
            return F.struct(stack.alias("before"), F.when(opens, F.array_append(stack, tag["name"])).otherwise(closed).alias("stack"))

        def noted(now: Column) -> Column:
            lowest = F.least(F.size(now["before"]), F.size(now["stack"]))
            ends = (state["skip"] > 0) & (lowest < state["skip"])
            ranges = F.when(ends, F.array_append(state["ranges"], F.struct(state["start"].alias("start"), tag["at"].alias("end")))).otherwise(state["ranges"])
            begins = ((state["skip"] == 0) | ends) & opens & tag["name"].isin(*side)
            skip = F.when(begins, F.size(now["stack"])).when(ends, F.lit(0)).otherwise(state["skip"])
            start = F.when(begins, tag["at"]).otherwise(state["start"])
            return F.struct(now["stack"].alias("stack"), skip.alias("skip"), start.alias("start"), ranges.alias("ranges")).cast(_STATE)

        return _let(_let(above, moved), noted)

    nothing = F.struct(
        F.array().cast("array<string>").alias("stack"),
        F.lit(0).alias("skip"),
        F.lit(0).alias("start"),
        F.array().cast("array<struct<start: int, end: int>>").alias("ranges"),
    ).cast(_STATE)

    def finish(state: Column) -> Column:
        last = F.struct(state["start"].alias("start"), end.alias("end"))
        return F.when(state["skip"] > 0, F.array_append(state["ranges"], last)).otherwise(state["ranges"])

    return F.aggregate(tags, nothing, step, finish)


def decode_references(text: Column) -> Column:
    """Replace all character references of HTML: by number, by name, and the old names that need no semicolon."""
    ended = {name.removesuffix(";"): value for name, value in html5.items() if name.endswith(";")}
    bare = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
    names = F.from_json(F.lit(json.dumps(ended)), "map<string,string>")
    windows = F.from_json(F.lit(json.dumps({str(code): value for code, value in WINDOWS.items()})), "map<string,string>")

    def character(number: Column) -> Column:
        code = F.coalesce(number, F.lit(0))
        valid = (code > 0) & (code < 0xD800) | (code > 0xDFFF) & (code <= 0x10FFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.coalesce(F.try_element_at(windows, code.cast("string")), plain)

    def decoded(part: Column, place: Column) -> Column:
        hexadecimal = F.regexp_extract(part, r"^#[xX]0*([0-9a-fA-F]{1,6})(?![0-9a-fA-F]);?", 1)
        decimal = F.regexp_extract(part, r"^#0*([0-9]{1,7})(?![0-9]);?", 1)
        name = F.regexp_extract(part, r"^([a-zA-Z][a-zA-Z0-9]*);", 1)
        old = F.regexp_extract(part, f"^(?:{'|'.join(bare)})", 0)
        rest = F.regexp_replace(part, r"^#[xX]?[0-9a-fA-F]+;?", "")
        digits = F.regexp_replace(part, r"^#[0-9]+;?", "")
        named = F.try_element_at(names, name)
        changed = (
            F.when(hexadecimal != "", F.concat(character(F.conv(hexadecimal, 16, 10).cast("int")), rest))
            .when(decimal != "", F.concat(character(decimal.cast("int")), digits))
            .when(part.rlike(r"^#[xX][0-9a-fA-F]"), F.concat(F.lit(UNKNOWN), rest))
            .when(part.rlike(r"^#[0-9]"), F.concat(F.lit(UNKNOWN), digits))
            .when((name != "") & named.isNotNull(), F.concat(named, F.substr(part, F.char_length(name) + 2)))
            .when(old != "", F.concat(F.try_element_at(names, old), F.substr(part, F.char_length(old) + 1)))
            .otherwise(F.concat(F.lit("&"), part))
        )
        return F.when(place == 0, part).otherwise(changed)

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&", -1), decoded), "")).otherwise(text)


def html_main_text(html: Column, side_elements: tuple[str, ...] = SIDE_ELEMENTS) -> Column:
    """The text of a page without comments, side elements and tags, white space as single spaces; null stays null.

    An element without an end tag ends where the element that it is in does; scripts and styles then reach to the end of the
    page, and a head to the first element of the body.
    """

    def visible(tokens: Column) -> Column:
        tags = F.filter(tokens, lambda one: one["kind"] != TEXT)
        end = F.try_element_at(tokens, F.lit(-1))["at"] + 1

        def outside(ranges: Column) -> Column:
            texts = F.filter(
                tokens,
                lambda one: (one["kind"] == TEXT) & ~F.exists(ranges, lambda r: (one["at"] >= r["start"]) & (one["at"] < r["end"])),
            )
            return F.array_join(F.transform(texts, lambda one: one["text"]), " ")

        return _let(_hidden_ranges(tags, side_elements, F.coalesce(end, F.lit(0))), outside)

    text = _let(_tokens(html, side_elements), visible)
    return F.when(html.isNotNull(), strip(F.regexp_replace(_let(text, decode_references), rf"{SPACE}+", " ")))
