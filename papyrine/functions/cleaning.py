"""The markdown cleaner: ordered regex rules, run as native expressions.

Every rule names a literal that any match must contain. The cleaner tests for it first, which is a byte search, so a
document without tables, math or brackets never pays for decoding and matching those patterns. Rules whose matches lie
within a line run line by line, so that of a long document only the lines with the literal are matched.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from itertools import groupby
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.texts import SPACE


# Where the matches of a rule are: at the start of the text only, within one line each, or anywhere.
START, LINE, TEXT = "start", "line", "text"


class Rule(NamedTuple):
    name: str
    pattern: str
    replacement: str
    needs: str
    reach: str = TEXT
    ends: str = ""  # no match reaches beyond the last of these


CAPTION_WORD = "Gambar"


def rules(caption_word: str = CAPTION_WORD) -> list[Rule]:
    """The rules in the order they apply.

    Fixed values: patterns and order decide the output. `(?d)` makes `.` and `^` treat only a newline as a line end.
    The possessive `*+` in `tables` keeps Java from recursing once per table row.
    """
    return [
        Rule("front_matter", r"(?s)\A---.*?---", "", "---", START),
        Rule("title", rf"(?d)\A#{SPACE}*(.*?)\n", "$1\n", "#", START, "\n"),
        Rule("h4", rf"(?md)^####{SPACE}*(.*?)\n", "$1\n", "####", ends="\n"),
        Rule("h2", rf"(?md)^##{SPACE}*(.*?)\n", "$1\n", "##", ends="\n"),
        Rule("bold", r"(?d)\*\*.*?\*\*", "", "**", LINE),
        Rule("math", r"(?d)\$.*?\$", "", "$", LINE),
        Rule("brackets", r"(?d)\[.*?\]", "", "[", LINE, "]"),
        Rule("parens", r"(?d)\(.*?\)", "", "(", LINE, ")"),
        Rule("captions", rf"(?d){re.escape(caption_word)} \p{{Nd}}+\..*", "", caption_word, LINE),
        Rule("tables", r"\|[^\n]*\|(?:\n\|[-:| ]+\|)?(?:\n\|[^\n]*\|)*+", "", "|"),
        Rule("keywords", r"(?s)Keywords:.*?(?=\n\n)", "", "Keywords:", ends="\n\n"),
        Rule("whitespace", rf"{SPACE}+", " ", ""),
    ]


def apply_rule(text: Column, rule: Rule) -> Column:
    """One rule as a column expression.

    A lazy pattern without an end looks for it from every beginning, which takes the square of a text's length. So what
    follows the last possible end is set aside.
    """
    if not rule.ends:
        return F.regexp_replace(text, rule.pattern, rule.replacement)

    def upto_last_end(value: Column) -> Column:
        rest = F.substring_index(value, rule.ends, -1)
        head = F.left(value, F.char_length(value) - F.char_length(rest))
        return F.concat(F.regexp_replace(head, rule.pattern, rule.replacement), rest)

    return F.element_at(F.transform(F.array(text), upto_last_end), 1)


def _guarded(rule: Rule) -> Callable[[Column], Column]:
    def step(value: Column) -> Column:
        possible = F.startswith if rule.reach == START else F.contains
        return F.when(possible(value, F.lit(rule.needs)), apply_rule(value, rule)).otherwise(value)

    return step


def _by_line(group: list[Rule]) -> Callable[[Column], Column]:
    def step(value: Column) -> Column:
        lines = F.split(value, "\n")
        for rule in group:
            lines = F.transform(lines, _guarded(rule))
        concerned = reduce(or_, [F.contains(value, F.lit(rule.needs)) for rule in group])
        return F.when(concerned, F.array_join(lines, "\n")).otherwise(value)

    return step


def clean_text(text: Column, caption_word: str = CAPTION_WORD) -> Column:
    """The whole cleaner. Null stays null.

    The text travels in an array of one, so that each rule's guard can name it without repeating the expression that made
    it. Repeated, or put in a column per rule, the expression would triple with every rule as soon as a filter on the
    result is pushed down.
    """
    *marks, whitespace = rules(caption_word)
    held = F.array(text)
    for reach, group in groupby(marks, key=lambda rule: rule.reach):
        steps = [_by_line(list(group))] if reach == LINE else map(_guarded, group)
        for step in steps:
            held = F.transform(held, step)
    return F.trim(apply_rule(F.element_at(held, 1), whitespace))
