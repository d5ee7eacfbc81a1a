"""Quality rules for texts: a table of thresholds compiled into one Spark projection.

A row of the table bounds one measure: a ratio of two counts of the text, or a count.
Counts are DataFrame functions of the text alone, so a plan holds no user function and
no shuffle, and the verdict is one conjunction. Bounds are compared in the form
``count <= bound * other count``, so nothing is divided by nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base test: fewest words, percent of words in repeated windows, window words.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3

#: What parts words, what counts as a symbol, what is cut off a word before it is looked up.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
EDGES = ".,;:?\"'()"

#: Common closed-class words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from or not have he you they which"
    " der die und den von zu das mit sich des ein auf für ist im nicht dem eine als auch es an werden aus er hat dass sie nach"
    " de la le et les en un du une que pour est par qui dans avec sur pas au ce il ne se plus sont ou son"
    " el y los del las por con no su para es al lo como más o pero sus una"
).split()


class Rule(NamedTuple):
    """``least * per <= count <= most * per``; an end that is None is open."""

    name: str
    count: str
    per: str | None
    least: float | None = None
    most: float | None = None


#: The threshold table: length, symbol, stop-word and line ratios. One line said twice
#: in a text of three is no sign, so the bound on repeated lines lies above a third.
RULES = (
    Rule("enough_words", "n_words", None, least=LEAST_WORDS),
    Rule("word_length", "word_chars", "n_words", least=3.0, most=14.0),
    Rule("few_symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.06),
    Rule("few_repeated_lines", "n_dup_lines", "n_lines", most=0.4),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _covered(places: Column, window: int) -> Column:
    """How many places the windows that start at some places cover."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.sort_array(places),
        start,
        lambda acc, p: F.struct(
            (acc["n"] + p + window - F.greatest(acc["end"], p)).alias("n"), (p + window).alias("end")
        ),
        lambda acc: acc["n"],
    )


def _next_to_equal(ordered: Column, pairs: Column, place: Callable[[Column], Column]) -> Column:
    """The places of those that equal a neighbour; ``pairs`` is 1 where the next one is equal."""
    either = F.transform(
        ordered,
        lambda x, i: F.when(
            (F.get(pairs, i) == 1) | F.coalesce(F.get(pairs, i - 1) == 1, F.lit(False)), place(x).cast("int")
        ),
    )
    return F.filter(either, lambda p: p.isNotNull())


def repeated_words(words: Column, window: int = WINDOW, place_bits: int = 24) -> Column:
    """How many words lie in a window of so many words that is found twice or more in the list.

    Each window is a long, a hash above its place; sorted, windows of one hash are
    neighbours, and their words are compared. Should two different windows share a hash,
    or a list be too long for its places, the windows themselves are sorted instead.
    The places of those with an equal neighbour, in order, cover the words.
    """
    places = (1 << place_bits) - 1

    def word(at: Column, k: int) -> Column:
        return F.get(words, at.cast("int") + k)

    def packed(i: Column) -> Column:
        hashed = F.xxhash64(*[word(i, k) for k in range(window)])
        return hashed.bitwiseAND(F.lit(~places)).bitwiseOR(i.cast("long"))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(places))

    def pair(x: Column, y: Column) -> Column:
        equal = F.lit(True)
        for k in range(window):
            equal = equal & (word(place(x), k) == word(place(y), k))
        apart = F.coalesce(F.shiftright(x.bitwiseXOR(y), place_bits) != 0, F.lit(True))
        return F.when(apart, 0).when(equal, 1).otherwise(2)

    def by_hash(ordered: Column) -> Column:
        def counted(pairs: Column) -> Column:
            mixed = F.exists(pairs, lambda p: p == 2)
            found = _covered(_next_to_equal(ordered, pairs, place), window)
            return F.when(mixed, _by_words(words, window)).otherwise(found)

        return _let(F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), pair), counted)

    starts = F.sequence(F.lit(0), F.size(words) - window)
    quick = _let(F.sort_array(F.transform(starts, packed)), by_hash)
    counted = F.when(F.size(words) > places, _by_words(words, window)).otherwise(quick)
    return F.when(F.size(words) > window, counted).otherwise(0).cast("long")


def _by_words(words: Column, window: int) -> Column:
    """:func:`repeated_words` by sorting the windows word by word."""

    def at(i: Column) -> Column:
        return F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(window)], i.alias("at"))

    def pair(x: Column, y: Column) -> Column:
        equal = F.lit(True)
        for k in range(window):
            equal = equal & (x[f"w{k}"] == y[f"w{k}"])
        return F.when(F.coalesce(equal, F.lit(False)), 1).otherwise(0)

    def counted(ordered: Column) -> Column:
        pairs = F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), pair)
        return _let(pairs, lambda p: _covered(_next_to_equal(ordered, p, lambda x: x["at"]), window))

    return _let(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - window), at)), counted)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _lines(text: Column) -> Column:
    """The text's lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.length(_without(line, SPACE)) > 0)


def _stop_words(words: Column, listed: Sequence[str]) -> Column:
    """Words of the list, in lower case or with a capital in front, punctuation at their ends aside."""
    forms = sorted({*listed, *(w.capitalize() for w in listed)})
    return F.size(F.filter(words, lambda w: F.btrim(w, F.lit(EDGES)).isin(forms)))


def measured(docs: DataFrame, text_col: str, *kept: Column, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``kept`` and the counts of each text, as longs; a null text counts as an empty one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(*kept, text.alias("_text"), F.regexp_extract_all(text, F.lit(WORD), 0).alias("_words"), _lines(text).alias("_lines"))
    text, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(_without(text, SPACE)),
        "n_symbols": F.length(text) - F.length(_without(text, SYMBOLS)),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_stop_words": _stop_words(words, stop_words),
    }
    names = [c for c in split.columns if c not in ("_text", "_words", "_lines")]
    return split.select(*names, *[c.cast("long").alias(name) for name, c in counts.items()])


def verdict(rules: Sequence[Rule] = RULES) -> Column:
    """All rules of the table as one condition on the counts."""
    holds = F.lit(True)
    for rule in rules:
        per = F.col(rule.per) if rule.per else F.lit(1)
        if rule.least is not None:
            holds = holds & (F.col(rule.count) >= F.lit(float(rule.least)) * per)
        if rule.most is not None:
            holds = holds & (F.col(rule.count) <= F.lit(float(rule.most)) * per)
    return holds


def failed_rules(rules: Sequence[Rule] = RULES) -> Column:
    """The names of the rules that a row of counts breaks, in the table's order."""
    broken = [F.when(~verdict([rule]), F.lit(rule.name)) for rule in rules]
    return F.array_compact(F.array(*broken))


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Rows ``doc_id``, the counts of :func:`measured`, ``base_failed``, ``kept`` and ``failed_rules``.

    One row for each row of ``docs``, in one projection: nothing is shuffled, so
    neither hot sources nor groups of copies matter, and repeated rows are judged
    alike. A null or empty text has no words, fails the base test and is not kept;
    a null id stays null; an empty table gives an empty result. Other columns are
    not read, whatever they are called. A text is held whole with its words and
    windows, in some 100 bytes of memory a word. A ratio that equals its bound
    holds. Stop words of all languages form one list, so a wrong or missing language
    does not matter.
    """
    counts = measured(docs, text_col, F.col(id_col).cast("long").alias("doc_id"), stop_words=stop_words)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return counts.select(
        "*", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"), failed_rules(rules).alias("failed_rules")
    )
