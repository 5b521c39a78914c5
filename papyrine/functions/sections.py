"""Sections of a text in the target language and in others.

A text with scattered foreign terms and one with a foreign chapter can have the same share of foreign words. So the windows
of `papyrine.functions.language` are divided into sections: each section is taken to be in the target language or not, and
the division is the best there is. A window counts its letters for the section it fits, and against one it doesn't; each
border between sections costs `BORDER` letters. Single windows that stray are not worth two borders, a chapter is. The best
division is found in one pass over the windows, which remembers the best so far that ends in either kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.language import FUNCTION_WORDS, WINDOW, _digits, _occurrences, _words_of

BORDER = 150  # letters; about a window and a half
LONGEST = 1_000  # letters of a foreign section that is still not substantial

_PATH = "array<struct<target: boolean, first: int>>"


def _windows(text: Column, target: str, words: dict[str, list[str]]) -> Column:
    """(letters, target) for each window of WINDOW words; the last one takes what is left over."""
    place = list(words).index(target)

    def window(held: Column, number: Column, count: Column) -> Column:
        size = F.when(number == count - 1, F.size(held["words"])).otherwise(F.lit(WINDOW))
        letters = F.char_length(F.array_join(F.slice(held["words"], number * WINDOW + 1, size), "")).cast("long")
        digits = F.array(F.array_join(F.slice(held["digits"], number * WINDOW + 1, size), ""))

        def wins(own: Column) -> Column:
            others = [_occurrences(own, other) for other in range(len(words)) if other != place]
            return _occurrences(own, place) > F.greatest(*others, F.lit(0))

        return F.struct(letters.alias("letters"), F.element_at(F.transform(digits, wins), 1).alias("target"))

    def cut(held: Column) -> Column:
        count = F.greatest(F.floor(F.size(held["words"]) / WINDOW), F.lit(1)).cast("int")
        found = F.transform(F.sequence(F.lit(0), count - 1), lambda number: window(held, number, count))
        return F.when(F.size(held["words"]) > 0, found)

    held = F.array(F.struct(_words_of(text).alias("words")))
    held = F.transform(held, lambda one: F.struct(one["words"].alias("words"), _digits(one["words"], words).alias("digits")))
    return F.element_at(F.transform(held, cut), 1)


def _best_division(windows: Column, border: int) -> Column:
    """The sections' kinds and first windows, in the division with the most letters that fit less those that don't."""

    def begin(kind: bool, first: Column) -> Column:
        return F.array(F.struct(F.lit(kind).alias("target"), first.cast("int").alias("first")))

    def step(best: Column, window: Column) -> Column:
        gain = F.when(window["target"], window["letters"]).otherwise(-window["letters"])
        turn_in, turn_out = best["out"] - border > best["in"], best["in"] - border > best["out"]
        return F.struct(
            (best["at"] + 1).alias("at"),
            (F.when(turn_in, best["out"] - border).otherwise(best["in"]) + gain).alias("in"),
            (F.when(turn_out, best["in"] - border).otherwise(best["out"]) - gain).alias("out"),
            F.when(turn_in, F.concat(best["out_path"], begin(True, best["at"]))).otherwise(best["in_path"]).alias("in_path"),
            F.when(turn_out, F.concat(best["in_path"], begin(False, best["at"]))).otherwise(best["out_path"]).alias("out_path"),
        )

    zero = F.lit(0).cast("long")
    nothing = F.struct(
        F.lit(0).alias("at"),
        zero.alias("in"),
        zero.alias("out"),
        begin(True, F.lit(0)).cast(_PATH).alias("in_path"),
        begin(False, F.lit(0)).cast(_PATH).alias("out_path"),
    )
    return F.aggregate(windows, nothing, step, lambda best: F.when(best["in"] >= best["out"], best["in_path"]).otherwise(best["out_path"]))


def language_sections(text: Column, target: str, border: int = BORDER, words: dict[str, list[str]] | None = None) -> Column:
    """array<struct<target: boolean, first_window: int, windows: int, letters: long, target_letters: long>>; null without a letter.

    Sections follow each other, cover the text, and are in turn in the target language and not. `target_letters` are those of
    the section's windows that are in the target language by themselves. Of equally good divisions the one with the later
    borders is taken, and the target language goes first.
    """
    words = words or FUNCTION_WORDS

    def sections(held: Column) -> Column:
        windows, path = held["windows"], held["path"]

        def section(part: Column, number: Column) -> Column:
            end = F.coalesce(F.try_element_at(path, number + 2)["first"], F.size(windows))
            own = F.slice(windows, part["first"] + 1, end - part["first"])
            letters = F.aggregate(own, F.lit(0).cast("long"), lambda total, one: total + one["letters"])
            fitting = F.aggregate(own, F.lit(0).cast("long"), lambda total, one: total + F.when(one["target"], one["letters"]).otherwise(0))
            return F.struct(
                part["target"].alias("target"),
                part["first"].alias("first_window"),
                (end - part["first"]).alias("windows"),
                letters.alias("letters"),
                fitting.alias("target_letters"),
            )

        return F.transform(path, section)

    held = F.array(F.struct(_windows(text, target, words).alias("windows")))
    held = F.filter(held, lambda one: one["windows"].isNotNull())
    held = F.transform(held, lambda one: F.struct(one["windows"].alias("windows"), _best_division(one["windows"], border).alias("path")))
    return F.try_element_at(F.transform(held, sections), F.lit(1))


def target_share(sections: Column) -> Column:
    """The share of a text's letters that stand in sections of the target language; null without a letter."""
    nothing = F.struct(F.lit(0).cast("long").alias("target"), F.lit(0).cast("long").alias("all"))

    def add(total: Column, one: Column) -> Column:
        target = total["target"] + F.when(one["target"], one["letters"]).otherwise(0)
        return F.struct(target.alias("target"), (total["all"] + one["letters"]).alias("all"))

    return F.aggregate(sections, nothing, add, lambda total: F.try_divide(total["target"], total["all"]))


def longest_foreign(sections: Column) -> Column:
    """The letters of the longest section in other languages; 0 where there is none, null without a letter."""
    letters = F.transform(F.filter(sections, lambda one: ~one["target"]), lambda one: one["letters"])
    return F.when(sections.isNotNull(), F.coalesce(F.array_max(letters), F.lit(0).cast("long")))


def is_mainly_in_sections(sections: Column, threshold: float = 0.8, longest: int = LONGEST) -> Column:
    """True when `threshold` of a text's letters is in sections of the target language and no foreign one is substantial."""
    return F.coalesce((target_share(sections) >= threshold) & (longest_foreign(sections) <= longest), F.lit(False))
