"""Changing which columns a table has and what they are called."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted

# Endings that a number or a word keeps.
ORDINAL_ENDINGS = ("st", "nd", "rd", "th")
CONTRACTIONS = ("d", "ll", "m", "re", "s", "t", "ve")
APOSTROPHES = "'\u2019"


def _kind(character: str) -> str:
    """What a character is to a word: digit, capital, small letter, other letter or nothing."""
    if character.isdigit():
        return "digit"
    if character.isalpha():
        return "capital" if character.isupper() else "small" if character.islower() else "letter"
    return ""


def _runs(name: str) -> list[tuple[str, str]]:
    """Stretches of characters of one kind."""
    runs: list[tuple[str, str]] = []
    for character in name:
        kind = _kind(character)
        if runs and runs[-1][0] == kind:
            runs[-1] = (kind, runs[-1][1] + character)
        else:
            runs.append((kind, character))
    return runs


def _is_ordinal(number: str, ending: str) -> bool:
    """Whether a number's last digit takes the ending: 1st, 22nd, 3rd, 4th, 11st."""
    if ending.lower() not in ORDINAL_ENDINGS or not (ending.islower() or ending.isupper()):
        return False
    return ending.lower() == {"1": "st", "2": "nd", "3": "rd"}.get(number[-1], "th")


def words(name: str) -> list[str]:
    """The words of a name.

    A word is a run of digits, with the ending of an ordinal; a run of capitals; or a run
    of small letters behind at most one capital, so that the last of several capitals
    belongs to the small letters after it. A contraction is one word with its
    apostrophe.
    """
    runs, found = _runs(name), []
    i = 0
    while i < len(runs):
        kind, text = runs[i]
        following = runs[i + 1] if i + 1 < len(runs) else ("", "")
        i += 1
        if not kind:
            continue
        if kind == "digit" and following[0] in ("small", "capital") and _is_ordinal(text, following[1]):
            text += following[1]
            i += 1
        elif kind == "capital" and following[0] == "small":
            if len(text) > 1:
                found.append(text[:-1])
            text = text[-1] + following[1]
            i += 1
        if kind != "digit" and i + 1 < len(runs) and runs[i][1] in APOSTROPHES:
            # Only a whole ending of one case counts, not the beginning of another word.
            ending = runs[i + 1][1]
            last = i + 2 >= len(runs) or runs[i + 2][0] not in ("small", "capital")
            if last and ending.lower() in CONTRACTIONS and runs[i + 1][0] in ("small", "capital"):
                text += runs[i][1] + ending
                i += 2
        found.append(text)
    return found


def snake_case(name: str) -> str:
    return "_".join(words(name)).lower()


def constant_case(name: str) -> str:
    return snake_case(name).upper()


def camel_case(name: str) -> str:
    first, *rest = words(name) or [""]
    return first.lower() + "".join(w[0].upper() + w[1:].lower() for w in rest)


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns, in table order; unknown names are ignored."""
    wanted = set(names)
    return df.select(*[quoted(c) for c in df.columns if c in wanted])


def omit(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, old: str, new: str, keep_old: bool = False) -> DataFrame:
    """Give a column another name, or copy it; a missing column changes nothing."""
    if old not in df.columns:
        return df
    if keep_old:
        return df.withColumn(new, quoted(old))
    return df.drop(new).withColumnRenamed(old, new) if old != new else df


def rename_all(df: DataFrame, change: Callable[[str], str]) -> DataFrame:
    """Rename every column by a function, for instance :func:`snake_case`."""
    names = [change(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("two columns would get the same name")
    return df.toDF(*names)


def parse_json(
    df: DataFrame, text: str, schema: T.StructType | str, into: str, bad: str | None = None
) -> DataFrame:
    """Parse a JSON text column; text that does not fit gives null.

    ``bad`` names a flag that is true for a text that is there but does not fit.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    corrupt = "_tw_corrupt"
    checked = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(quoted(text), checked, {"columnNameOfCorruptRecord": corrupt})
    held = df.withColumn("_tw_json", parsed)
    broken = F.col("_tw_json").getField(corrupt).isNotNull() | (
        quoted(text).isNotNull() & F.col("_tw_json").isNull()
    )
    fields = F.struct(*[F.col("_tw_json").getField(n).alias(n) for n in schema.names])
    held = held.withColumn(into, F.when(~broken & quoted(text).isNotNull(), fields))
    if bad is not None:
        held = held.withColumn(bad, broken)
    return held.drop("_tw_json")
