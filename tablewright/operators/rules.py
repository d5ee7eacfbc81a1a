"""Rules for the fields of a record, as immutable descriptions.

A :class:`Field` holds what is done to a cell (transforms, default, cast) and
what is asked of it.  Checks come in two stages: type, presence and allowed
values first, and the other tests only where these pass.  Spark has one null, so
"null" and "missing" are one thing here, called *absent*.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import patterns
from tablewright.functions.dates import iso_is_utc, iso_millis_of, iso_precision
from tablewright.functions.text import trimmed, utf16_length
from tablewright.sources.literals import small_frame

# Message of each rule; ${name} stands for a parameter.
MESSAGES = {
    "default": "${path} is invalid",
    "required": "${path} is a required field",
    "defined": "${path} must be defined",
    "not_null": "${path} cannot be null",
    "one_of": "${path} must be one of the following values: ${values}",
    "not_one_of": "${path} must not be one of the following values: ${values}",
    "type": (
        "${path} must be a `${type}` type, but the final value was: `${invalid}`"
        ' (cast from the value `"${value}"`).'
    ),
    "length": "${path} must be exactly ${length} characters",
    "min": "${path} must be at least ${min} characters",
    "max": "${path} must be at most ${max} characters",
    "matches": '${path} must match the following: "${regex}"',
    "email": "${path} must be a valid email",
    "url": "${path} must be a valid URL",
    "uuid": "${path} must be a valid UUID",
    "datetime": "${path} must be a valid ISO date-time",
    "datetime_precision": (
        "${path} must be a valid ISO date-time with a sub-second precision of exactly"
        " ${precision} digits"
    ),
    "datetime_offset": '${path} must be a valid ISO date-time with UTC "Z" timezone',
    "trim": "${path} must be a trimmed string",
    "lowercase": "${path} must be a lowercase string",
    "uppercase": "${path} must be a upper case string",
    "date_min": "${path} field must be later than ${min}",
    "date_max": "${path} field must be at earlier than ${max}",
    "no_unknown": "${path} field has unspecified keys: ${unknown}",
    "exact": "${path} object contains unknown properties: ${properties}",
}

_PLACEHOLDER = re.compile(r"\$\{\s*(\w+)\s*\}")


class InvalidRecords(ValueError):
    """Rows break rules; ``failures`` maps (field, rule) to the number of rows."""

    def __init__(self, failures: dict[tuple[str, str], int]):
        self.failures = failures
        listed = ", ".join(f"{f}: {rule} ({n} rows)" for (f, rule), n in failures.items())
        super().__init__(f"rows break rules - {listed}")


class RuleError(ValueError):
    """A rule that cannot be applied to its field."""


@dataclass(frozen=True)
class Ref:
    """A value taken from elsewhere: ``name`` a sibling, ``$name`` the context, ``.`` itself."""

    key: str
    map: Callable[[Column], Column] | None = None

    def __post_init__(self):
        if not self.key.strip():
            raise RuleError("a reference needs a name")

    def column(self, scope: Scope) -> Column:
        key = self.key.strip()
        if key.startswith("$"):
            c = F.lit(scope.context.get(key[1:]))
        elif key.startswith("."):
            c = reduce(lambda v, step: v.getField(step), filter(None, key.split(".")), scope.value)
        else:
            c = scope.sibling(key)
        return self.map(c) if self.map else c


@dataclass(frozen=True)
class Scope:
    """What a test may look at: the cast cell, its siblings and the caller's context."""

    value: Column
    sibling: Callable[[str], Column]
    context: Mapping[str, Any]

    def resolve(self, value) -> Column:
        if isinstance(value, Ref):
            return value.column(self)
        return value if isinstance(value, Column) else F.lit(value)


Check = Callable[[Scope], Column]


@dataclass(frozen=True)
class Test:
    """One named second-stage check; ``check`` gives true where the cell is good."""

    name: str
    message: str
    check: Check
    params: tuple[tuple[str, Any], ...] = ()
    skip_absent: bool = True
    exclusive: bool = False


@dataclass(frozen=True)
class Condition:
    """Rules that hold only where a test on other fields is true, and others elsewhere."""

    refs: tuple[Ref, ...]
    test: Any
    then: Callable[[Field], Field] | None
    otherwise: Callable[[Field], Field] | None

    def holds(self, scope: Scope) -> Column:
        columns = [r.column(scope) for r in self.refs]
        if callable(self.test):
            return F.coalesce(self.test(*columns), F.lit(False))
        return reduce(and_, [c.eqNullSafe(F.lit(self.test)) for c in columns])


@dataclass(frozen=True)
class Field:
    """Rules of one field.  ``kind`` is ``string``, ``date`` or a Spark type to cast to."""

    name: str
    kind: str = "string"
    title: str | None = None
    absent: tuple[str, str] | None = None
    type_message: str = MESSAGES["type"]
    allowed: tuple = ()
    allowed_message: str = MESSAGES["one_of"]
    denied: tuple = ()
    denied_message: str = MESSAGES["not_one_of"]
    transforms: tuple[Callable[[Column], Column], ...] = ()
    fill: Any = None
    tests: tuple[Test, ...] = ()
    conditions: tuple[Condition, ...] = ()
    is_strict: bool = False
    stripped: bool = False
    notes: Mapping[str, Any] = field(default_factory=dict)

    @property
    def label(self) -> str:
        return self.title or self.name

    # -- presence ---------------------------------------------------------

    def required(self, message: str = MESSAGES["required"]) -> Field:
        """Present and, for texts, not empty."""
        out = replace(self, absent=("required", message))
        if self.kind != "string":
            return out
        return out.test("required", message, lambda s: F.length(s.value) > 0, exclusive=True)

    def not_required(self) -> Field:
        tests = tuple(t for t in self.tests if t.name != "required")
        return replace(self, absent=None, tests=tests)

    def non_nullable(self, message: str = MESSAGES["not_null"]) -> Field:
        return replace(self, absent=("not_null", message))

    def defined(self, message: str = MESSAGES["defined"]) -> Field:
        return replace(self, absent=("defined", message))

    def nullable(self) -> Field:
        return replace(self, absent=None)

    def optional(self) -> Field:
        return replace(self, absent=None)

    # -- allowed values and type -------------------------------------------

    def one_of(self, values: Iterable, message: str = MESSAGES["one_of"]) -> Field:
        values = tuple(values)
        return replace(
            self,
            allowed=(*self.allowed, *values),
            allowed_message=message,
            denied=tuple(v for v in self.denied if v not in values),
        )

    def not_one_of(self, values: Iterable, message: str = MESSAGES["not_one_of"]) -> Field:
        values = tuple(values)
        return replace(
            self,
            denied=(*self.denied, *values),
            denied_message=message,
            allowed=tuple(v for v in self.allowed if v not in values),
        )

    def type_error(self, message: str) -> Field:
        return replace(self, type_message=message)

    # -- tests --------------------------------------------------------------

    def test(
        self,
        name: str,
        message: str = MESSAGES["default"],
        check: Check | None = None,
        skip_absent: bool = True,
        exclusive: bool = False,
        **params,
    ) -> Field:
        """Add a named test; an exclusive one takes the place of its namesakes."""
        if check is None:
            raise RuleError("a test needs a check")
        new = Test(name, message, check, tuple(params.items()), skip_absent, exclusive)
        kept = tuple(
            t
            for t in self.tests
            if t.name != name or not (exclusive or t.exclusive or t.check is check)
        )
        return replace(self, tests=(*kept, new))

    def length(self, length, message: str = MESSAGES["length"]) -> Field:
        self._needs("string")
        return self.test(
            "length",
            message,
            lambda s: utf16_length(s.value) == s.resolve(length),
            exclusive=True,
            length=length,
        )

    def min(self, least, message: str | None = None) -> Field:
        """Fewest characters of a text, earliest moment of a date."""
        return self._bound("min", least, message, lambda a, b: a >= b)

    def max(self, most, message: str | None = None) -> Field:
        """Most characters of a text, latest moment of a date."""
        return self._bound("max", most, message, lambda a, b: a <= b)

    def _bound(self, name: str, bound, message: str | None, compare) -> Field:
        self._needs("string", "date")
        if self.kind == "string":

            def check(s: Scope) -> Column:
                return compare(utf16_length(s.value), s.resolve(bound))

            default = MESSAGES[name]
        else:

            moment = iso_millis_of(bound) if isinstance(bound, str) else None
            if isinstance(bound, str) and moment is None:
                raise RuleError(f"{bound!r} is no date")

            def check(s: Scope) -> Column:
                limit = s.resolve(bound) if moment is None else F.timestamp_millis(F.lit(moment))
                return compare(s.value, limit)

            default = MESSAGES["date_" + name]
        return self.test(name, message or default, check, exclusive=True, **{name: bound})

    def matches(
        self,
        regex: str,
        message: str = MESSAGES["matches"],
        name: str = "matches",
        exclude_empty: bool = False,
    ) -> Field:
        """The pattern is found somewhere in the text."""
        self._needs("string")

        def check(s: Scope) -> Column:
            found = s.value.rlike(regex)
            return (s.value == "") | found if exclude_empty else found

        return self.test(name, message, check, regex=regex)

    def email(self, message: str = MESSAGES["email"]) -> Field:
        return self.matches(patterns.EMAIL, message, "email", exclude_empty=True)

    def url(self, message: str = MESSAGES["url"]) -> Field:
        return self.matches(patterns.URL, message, "url", exclude_empty=True)

    def uuid(self, message: str = MESSAGES["uuid"]) -> Field:
        return self.matches(patterns.UUID, message, "uuid")

    def datetime(
        self, message: str = "", allow_offset: bool = False, precision: int | None = None
    ) -> Field:
        """ISO date and time, in UTC unless offsets are allowed, with exact fraction digits."""
        out = self.matches(
            patterns.DATETIME, message or MESSAGES["datetime"], "datetime", exclude_empty=True
        )
        if not allow_offset:
            out = out.test(
                "datetime_offset",
                message or MESSAGES["datetime_offset"],
                lambda s: (s.value == "") | iso_is_utc(s.value),
                allow_offset=allow_offset,
            )
        if precision is not None:
            out = out.test(
                "datetime_precision",
                message or MESSAGES["datetime_precision"],
                lambda s: (s.value == "") | (iso_precision(s.value) == precision),
                precision=precision,
            )
        return out

    # -- transforms -----------------------------------------------------------

    def transform(self, change: Callable[[Column], Column]) -> Field:
        return replace(self, transforms=(*self.transforms, change))

    def trim(self, message: str = MESSAGES["trim"]) -> Field:
        self._needs("string")
        return self.transform(trimmed).test("trim", message, lambda s: s.value == trimmed(s.value))

    def lowercase(self, message: str = MESSAGES["lowercase"]) -> Field:
        self._needs("string")
        out = self.transform(F.lower)
        return out.test("case", message, lambda s: s.value == F.lower(s.value), exclusive=True)

    def uppercase(self, message: str = MESSAGES["uppercase"]) -> Field:
        self._needs("string")
        out = self.transform(F.upper)
        return out.test("case", message, lambda s: s.value == F.upper(s.value), exclusive=True)

    def default(self, value) -> Field:
        """The value an absent cell takes."""
        return replace(self, fill=value)

    def ensure(self) -> Field:
        """An absent text becomes an empty one."""
        self._needs("string")
        return self.default("")

    def strict(self, on: bool = True) -> Field:
        """Test the cell as it is: no transforms and no default."""
        return replace(self, is_strict=on)

    def strip(self, on: bool = True) -> Field:
        """Leave the field out of the valid rows."""
        return replace(self, stripped=on)

    def titled(self, title: str) -> Field:
        return replace(self, title=title)

    # -- conditions -------------------------------------------------------------

    def when(
        self,
        keys: str | Iterable[str],
        is_,
        then: Callable[[Field], Field] | None = None,
        otherwise: Callable[[Field], Field] | None = None,
    ) -> Field:
        """Other rules where the named fields equal ``is_`` (or ``is_(*columns)`` is true)."""
        if then is None and otherwise is None:
            raise RuleError("a condition needs then or otherwise")
        keys = (keys,) if isinstance(keys, str) else tuple(keys)
        condition = Condition(tuple(Ref(k) for k in keys), is_, then, otherwise)
        return replace(self, conditions=(*self.conditions, condition))

    def when_built(self, keys: str | Iterable[str], build: Callable[..., Field]) -> Field:
        """Rules made from other fields: ``build(field, *references)`` gives the field.

        A reference stands for the sibling's value in each row, so it can be a rule's
        parameter (``lambda f, least: f.min(least)``).
        """
        keys = (keys,) if isinstance(keys, str) else tuple(keys)
        return build(self, *[Ref(k) for k in keys])

    def merged(self) -> Merged | None:
        """The field's rules under all its conditions, each listed once with where it holds.

        None if a condition changes more than rules (the type, a transform, a default),
        has conditions of its own, or if several change the listed values; then the
        field is taken apart by :meth:`branches`.
        """
        base = replace(self, conditions=())
        rules = [Guarded(t) for t in base.tests]
        absents, listed = [Guarded(base.absent)], [Guarded(base)]
        for i, condition in enumerate(self.conditions):
            before, made_rules, made_absents, made_listed = list(rules), [], [], []
            known = tuple(r.rule for r in before)
            for side, change in ((True, condition.then), (False, condition.otherwise)):
                if change is None:
                    continue
                probe = replace(base, tests=known, absent=_PROBE)
                made = change(probe)
                if any(getattr(made, n) is not getattr(probe, n) for n in _MORE_THAN_RULES):
                    return None
                at = (i, side)
                if made.absent is not _PROBE:
                    made_absents.append(Guarded(made.absent, at))
                if made.allowed is not probe.allowed or made.denied is not probe.denied:
                    made_listed.append(Guarded(made, at))
                for r in before:
                    if not any(t is r.rule for t in made.tests):
                        r.unless.append(at)
                new = [t for t in made.tests if not any(t is k for k in known)]
                made_rules += [Guarded(t, at) for t in new]
            if made_listed and len(listed) > 1:
                return None
            for earlier, later in ((absents, made_absents), (listed, made_listed)):
                for e in earlier:
                    e.unless.extend(x.where for x in later)
                earlier += later
            rules += made_rules
        return Merged(base, absents, listed, rules)

    def branches(self) -> tuple[Condition, Field, Field] | None:
        """The first condition with the field in either case, or None if there is none."""
        if not self.conditions:
            return None
        first, *rest = self.conditions
        base = replace(self, conditions=tuple(rest))
        return (
            first,
            first.then(base) if first.then else base,
            first.otherwise(base) if first.otherwise else base,
        )

    # -- listing -----------------------------------------------------------------

    def describe(self) -> list[tuple[str, str, str]]:
        """``(field, rule, parameters)`` of every rule, in the order they are checked."""
        listed = [(self.name, "type", f"type={self.kind}")]
        if self.absent:
            listed.append((self.name, self.absent[0], ""))
        if self.allowed:
            listed.append((self.name, "one_of", "values=" + _listing(self.allowed)))
        if self.denied:
            listed.append((self.name, "not_one_of", "values=" + _listing(self.denied)))
        seen = {rule for _, rule, _ in listed}
        for t in self.tests:
            if t.name not in seen:
                params = ", ".join(f"{k}={_plain(v)}" for k, v in t.params)
                listed.append((self.name, t.name, params))
                seen.add(t.name)
        return listed

    def _needs(self, *kinds: str) -> None:
        if self.kind not in kinds:
            raise RuleError(f"this rule is not for a {self.kind} field")


#: Stands for "whatever was there" while a condition is tried out.
_PROBE = ("", "")
_MORE_THAN_RULES = (
    "name", "kind", "title", "type_message", "transforms", "fill", "is_strict", "stripped", "conditions"
)


@dataclass
class Guarded:
    """A rule, the side of the condition it is from, and the sides that take it away."""

    rule: Any
    where: tuple[int, bool] | None = None
    unless: list[tuple[int, bool]] = field(default_factory=list)


@dataclass(frozen=True)
class Merged:
    """A field without its conditions, and what they make of its rules."""

    base: Field
    absents: list[Guarded]
    listed: list[Guarded]
    rules: list[Guarded]


@dataclass(frozen=True)
class RecordRules:
    """Rules of all fields of a record, in the order violations are listed.

    ``empty_as_absent`` treats an empty text as no value, as a form does.
    ``abort_early`` keeps the first violation of a row only.
    """

    fields: tuple[Field, ...] = ()
    empty_as_absent: bool = True
    abort_early: bool = False
    context: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        if len(set(self.names)) != len(self.names):
            raise RuleError("field names must be unique")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def __getitem__(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def shape(self, *fields: Field) -> RecordRules:
        """Add fields, or replace those of the same name in place."""
        new = {f.name: f for f in fields}
        kept = [new.pop(f.name, f) for f in self.fields]
        return replace(self, fields=(*kept, *new.values()))

    def concat(self, other: RecordRules) -> RecordRules:
        """The other rules, and those of these fields the other does not name."""
        rest = [f for f in self.fields if f.name not in other.names]
        return replace(other, fields=(*other.fields, *rest))

    def pick(self, names: Iterable[str]) -> RecordRules:
        names = set(names)
        return replace(self, fields=tuple(f for f in self.fields if f.name in names))

    def omit(self, names: Iterable[str]) -> RecordRules:
        names = set(names)
        return replace(self, fields=tuple(f for f in self.fields if f.name not in names))

    def partial(self) -> RecordRules:
        """Top-level fields may be absent."""
        return replace(
            self, fields=tuple(f if "." in f.name else f.optional() for f in self.fields)
        )

    def deep_partial(self) -> RecordRules:
        """Fields at any depth may be absent."""
        return replace(self, fields=tuple(f.optional() for f in self.fields))

    def describe(self) -> list[tuple[str, str, str]]:
        return [rule for f in self.fields for rule in f.describe()]

    def rules_frame(self, spark: SparkSession) -> DataFrame:
        """The rules as a table."""
        rows = [(i, *rule) for i, rule in enumerate(self.describe(), 1)]
        return small_frame(spark, rows, "pos bigint, field string, rule string, params string")

    def unknown_columns(self, df: DataFrame) -> list[str]:
        """Columns of a frame that no rule names; needs no pass over the data."""
        roots = {name.split(".")[0] for name in self.names}
        return [c for c in df.columns if c not in roots]


def render(template: str, params: Mapping[str, Any], scope: Scope) -> Column:
    """The message with its parameters; references are resolved row by row."""
    pieces: list[str | Column] = [""]
    end = 0

    def say(text: str) -> None:
        if isinstance(pieces[-1], str):
            pieces[-1] += text
        else:
            pieces.append(text)

    for found in _PLACEHOLDER.finditer(template):
        say(template[end : found.start()])
        value = params.get(found.group(1))
        if isinstance(value, (Ref, Column)):
            text = scope.resolve(value).cast("string")
            pieces.append(F.coalesce(text, F.lit("null")))
        else:
            say(_plain(value))
        end = found.end()
    say(template[end:])
    columns = [F.lit(p) if isinstance(p, str) else p for p in pieces if not isinstance(p, str) or p]
    return columns[0] if len(columns) == 1 else F.concat(*columns) if columns else F.lit("")


def _plain(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, Ref):
        return f"Ref({value.key})"
    return "null" if value is None else str(value)


def _listing(values: Iterable) -> str:
    return ", ".join(_plain(v) for v in values)
