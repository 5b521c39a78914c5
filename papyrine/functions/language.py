"""How much of a text is in one language, from function words.

A text is cut into windows of WINDOW words, the last of which also takes what is left over. A window belongs to the target
language when it holds more of its function words than of any other's. The share is that of the letters in such windows
among all letters, so what is in a language or script without listed words counts against the target.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW = 20

# Function words that are frequent in one of the languages and in no other's list. A single letter tells
# nothing, as formulas and tables are full of them.
FUNCTION_WORDS: dict[str, list[str]] = {
    "id": [
        "yang", "dan", "di", "dari", "untuk", "dengan", "pada", "ini", "itu", "dalam",
        "tidak", "adalah", "akan", "oleh", "sebagai", "juga", "atau", "ke", "dapat", "karena",
    ],
    "en": [
        "the", "and", "of", "to", "is", "that", "for", "with", "was", "are",
        "this", "by", "from", "which", "be", "it", "have", "not", "were", "at",
    ],
    "fr": [
        "le", "les", "des", "et", "est", "dans", "une", "pour", "qui", "sur",
        "pas", "du", "au", "avec", "ce", "sont", "plus", "nous", "vous", "aux",
    ],
    "de": [
        "der", "die", "und", "das", "nicht", "ist", "ein", "eine", "von", "mit",
        "den", "auf", "zu", "im", "für", "sich", "auch", "dem", "wird", "werden",
    ],
    "es": [
        "el", "los", "las", "del", "una", "por", "con", "para", "como", "más",
        "pero", "su", "al", "lo", "sus", "porque", "este", "entre", "cuando", "muy",
    ],
}


def _words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def _digits(found: Column, words: dict[str, list[str]]) -> Column:
    """For each word a digit that stands for its language, or nothing."""

    def digit(word: Column) -> Column:
        chosen = F.when(F.lit(False), F.lit(""))
        for place, listed in enumerate(words.values()):
            chosen = chosen.when(word.isin(listed), F.lit(str(place)))
        return chosen.otherwise(F.lit(""))

    return F.transform(found, digit)


def _occurrences(digits: Column, place: int) -> Column:
    return F.char_length(digits) - F.char_length(F.replace(digits, F.lit(str(place)), F.lit("")))


def language_share(text: Column, target: str, words: dict[str, list[str]] | None = None) -> Column:
    """Share of the letters that stand in windows of the target language; null when there is no letter."""
    words = words or FUNCTION_WORDS
    place = list(words).index(target)

    def window(held: Column, number: Column, count: Column) -> Column:
        size = F.when(number == count - 1, F.size(held["words"])).otherwise(F.lit(WINDOW))
        own = F.array_join(F.slice(held["digits"], number * WINDOW + 1, size), "")
        letters = F.char_length(F.array_join(F.slice(held["words"], number * WINDOW + 1, size), "")).cast("long")
        return F.struct(letters.alias("letters"), own.alias("digits"))

    def wins(one: Column) -> Column:
        others = [_occurrences(one["digits"], other) for other in range(len(words)) if other != place]
        return _occurrences(one["digits"], place) > F.greatest(*others, F.lit(0))

    def add(total: Column, one: Column) -> Column:
        target_letters = total["target"] + F.when(wins(one), one["letters"]).otherwise(0)
        return F.struct(target_letters.alias("target"), (total["all"] + one["letters"]).alias("all"))

    def share(held: Column) -> Column:
        count = F.greatest(F.floor(F.size(held["words"]) / WINDOW), F.lit(1)).cast("int")
        windows = F.transform(F.sequence(F.lit(0), count - 1), lambda number: window(held, number, count))
        nothing = F.struct(F.lit(0).cast("long").alias("target"), F.lit(0).cast("long").alias("all"))
        return F.aggregate(windows, nothing, add, lambda total: F.try_divide(total["target"], total["all"]))

    # The words travel in an array of one, so that they are found once.
    held = F.array(F.struct(_words_of(text).alias("words")))
    held = F.transform(held, lambda one: F.struct(one["words"].alias("words"), _digits(one["words"], words).alias("digits")))
    return F.element_at(F.transform(held, share), 1)


def detect_language(text: Column, words: dict[str, list[str]] | None = None) -> Column:
    """The language with the most function words in a text, in case of a tie the first listed; null without any."""
    words = words or FUNCTION_WORDS

    def most(digits: Column) -> Column:
        counts = [F.struct(_occurrences(digits, i).alias("n"), F.lit(-i).alias("place"), F.lit(name).alias("name")) for i, name in enumerate(words)]
        best = F.array_max(F.array(*counts))
        return F.when(best["n"] > 0, best["name"])

    joined = F.array_join(_digits(_words_of(text), words), "")
    return F.element_at(F.transform(F.array(joined), most), 1)


def is_mainly_in(text: Column, target: str, threshold: float = 0.8) -> Column:
    """True when at least `threshold` of the text is in the target language."""
    return F.coalesce(language_share(text, target) >= threshold, F.lit(False))
