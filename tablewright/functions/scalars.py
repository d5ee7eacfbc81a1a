"""Small per-row functions, all column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.text import utf16_length

SECONDS_PER_DAY = 86400

# Label of a password score, by the first bound the score is below.
STRENGTH_LABELS = ((2, "Poor"), (3, "Weak"), (4, "Normal"), (5, "Good"), (6, "Strong"))
# The characters that count as special in a password.
SPECIAL_CHARACTERS = "!#@$%^&*)(+=._-"


def mask_email(c: Column) -> Column:
    """Star out the local part but for its first and last character.

    Texts without ``@`` or with a local part below three characters stay as they are.
    """
    local = F.instr(c, "@") - 1
    masked = F.concat(
        F.substring(c, 1, 1), F.repeat(F.lit("*"), local - 2), F.substr(c, local)
    )
    return F.when(local >= 3, masked).otherwise(c)


def duration_split(seconds: Column) -> Column:
    """Days, hours, minutes and seconds of a duration, rounded up to whole seconds."""
    whole = F.ceil(seconds)
    return F.struct(
        whole.alias("total_seconds"),
        F.floor(whole / SECONDS_PER_DAY).alias("days"),
        F.floor(whole % SECONDS_PER_DAY / 3600).alias("hours"),
        F.floor(whole % 3600 / 60).alias("minutes"),
        (whole % 60).alias("seconds"),
    )


def clock(seconds: Column, twelve_hour: bool = False) -> Column:
    """Clock reading of a duration; on a 12-hour clock noon reads 0 pm."""
    parts = duration_split(seconds)
    hours = parts["hours"]
    half = F.when(hours >= 12, F.lit("pm")).otherwise(F.lit("am"))
    return F.struct(
        (hours % 12 if twelve_hour else hours).alias("hours"),
        parts["minutes"].alias("minutes"),
        parts["seconds"].alias("seconds"),
        (half if twelve_hour else F.lit("")).alias("ampm"),
    )


def epoch_millis(c: Column) -> Column:
    return F.unix_millis(c.cast("timestamp"))


def _positive_seconds(millis: Column, rounded: bool) -> Column:
    seconds = F.when(millis > 0, millis / F.lit(1000.0)).otherwise(F.lit(0.0))
    return F.floor(seconds + 0.5).cast("double") if rounded else seconds


def seconds_until(expiry: Column, now: Column, rounded: bool = False) -> Column:
    """Seconds from ``now`` to ``expiry``, 0 once it has passed, null for no expiry."""
    gap = epoch_millis(expiry) - epoch_millis(now)
    return F.when(gap.isNotNull(), _positive_seconds(gap, rounded))


def seconds_since(past: Column, now: Column, rounded: bool = False) -> Column:
    """Seconds from ``past`` to ``now``, 0 if it lies ahead, null for no time."""
    gap = epoch_millis(now) - epoch_millis(past)
    return F.when(gap.isNotNull(), _positive_seconds(gap, rounded))


def strength_score(c: Column) -> Column:
    """0 to 5: a point each for length > 5, length > 7, a digit, a special, both cases."""
    special = F.translate(c, SPECIAL_CHARACTERS, "") != c
    tests = (
        utf16_length(c) > 5,
        utf16_length(c) > 7,
        c.rlike("[0-9]"),
        special,
        c.rlike("[a-z]") & c.rlike("[A-Z]"),
    )
    score = F.lit(0)
    for test in tests:
        score = score + test.cast("int")
    return score


def strength_label(score: Column) -> Column:
    label = None
    for bound, name in STRENGTH_LABELS:
        label = (F if label is None else label).when(score < bound, F.lit(name))
    return label.otherwise(F.lit("Poor"))
