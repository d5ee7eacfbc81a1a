"""Apply record rules to a table: valid rows, rejected rows and a report.

Everything is a column expression, so checking adds no shuffle and no Python
worker to a scan.  Whether a row is valid is one boolean; the list of violations
is only built for rows that are rejected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.casts import tolerant_cast
from tablewright.functions.dates import iso_parts, iso_timestamp, timestamp_of
from tablewright.functions.text import quoted
from tablewright.operators.cells import nested, path_type
from tablewright.operators.predicates import comparable
from tablewright.operators.rules import (
    MESSAGES,
    Field,
    Guarded,
    InvalidRecords,
    Merged,
    RecordRules,
    Ref,
    RuleError,
    Scope,
    render,
)
from tablewright.sources.literals import small_frame

VALID = "_valid"
VIOLATIONS = "_violations"
_CAST = "_tw_cast_"
_RAW = "_tw_raw_"
_PARTS = "_tw_parts_"
_REPORT = "pos bigint, field string, rule string, failures bigint"
_LIST = "array<struct<field:string,rule:string,message:string>>"


@dataclass(frozen=True)
class Outcome:
    """``valid`` has cast cells, ``rejected`` the original ones and their violations."""

    valid: DataFrame
    rejected: DataFrame
    report: DataFrame


@dataclass(frozen=True)
class _Finding:
    """One rule on one field: where it is broken, and what is said about it."""

    field: str
    rule: str
    broken: Column
    message: Column

    def entry(self) -> Column:
        said = F.struct(
            F.lit(self.field).alias("field"),
            F.lit(self.rule).alias("rule"),
            self.message.alias("message"),
        )
        return F.when(self.broken, F.array(said)).otherwise(F.array().cast(_LIST))


class Checker:
    """The expressions that check one table against one set of rules."""

    def __init__(self, df: DataFrame, rules: RecordRules):
        self.df = df
        self.rules = rules
        # Each step is a projection of its own, so that costly cells, parts of dates
        # and casts are computed once however many rules look at them.
        self._types = {f.name: path_type(df.schema, f.name, ".") for f in rules.fields}
        missing = [name for name, dtype in self._types.items() if dtype is None]
        if missing:
            raise RuleError(f"the table has no column {missing[0]!r}")
        raw = df.withColumns({_RAW + f.name: self._raw(f) for f in rules.fields})
        dates = [f for f in rules.fields if f.kind == "date" and self._is_text(f)]
        parts = raw.withColumns({_PARTS + f.name: iso_parts(quoted(_RAW + f.name)) for f in dates})
        self.prepared = parts.withColumns({_CAST + f.name: self._cast(f, ()) for f in rules.fields})

    # -- values ---------------------------------------------------------------

    def _raw(self, f: Field) -> Column:
        c = nested(f.name, ".")
        return F.nullif(c, F.lit("")) if self._is_text(f) and self.rules.empty_as_absent else c

    def _is_text(self, f: Field) -> bool:
        return isinstance(self._types[f.name], T.StringType)

    def _cast(self, f: Field, path: tuple[str, ...]) -> Column:
        """The cell after transforms, cast and default; conditions choose among fields."""
        if f.name in path:
            raise RuleError("conditions refer to each other: " + " -> ".join((*path, f.name)))
        branches = f.branches()
        if branches is None:
            return self._cast_plain(f)
        if f.merged() is not None:
            return self._cast_plain(f)
        condition, then, otherwise = branches
        inner = (*path, f.name)

        def sibling(name: str) -> Column:
            if name == f.name:
                return quoted(_RAW + name)
            if name not in self.rules.names:
                return nested(name, ".")
            return self._cast(self.rules[name], inner)

        scope = Scope(quoted(_RAW + f.name), sibling, self.rules.context)
        return F.when(condition.holds(scope), self._cast(then, path)).otherwise(
            self._cast(otherwise, path)
        )

    def _cast_plain(self, f: Field) -> Column:
        value = quoted(_RAW + f.name)
        if f.kind == "string":
            value = value.cast("string")
        elif f.kind == "date":
            if self._is_text(f):
                # A branch may turn a field into a date that was none before.
                ready = f.name in self.rules.names and self.rules[f.name].kind == "date"
                value = timestamp_of(quoted(_PARTS + f.name)) if ready else iso_timestamp(value)
            else:
                value = value.cast("timestamp")
        elif f.kind != "mixed":
            value = tolerant_cast(value, self._types[f.name], f.kind)
        if f.is_strict:
            return value
        for change in f.transforms:
            value = change(value)
        if f.fill is None:
            return value
        fill = F.lit(f.fill)
        if _can_fail(f):  # a cell that would not cast is wrong, not absent
            fill = F.when(quoted(_RAW + f.name).isNull(), fill)
        return F.coalesce(value, fill)

    def _value(self, f: Field) -> Column:
        return quoted(_CAST + f.name)

    def _scope(self, f: Field) -> Scope:
        def sibling(name: str) -> Column:
            known = name in self.rules.names
            return quoted(_CAST + name) if known else nested(name, ".")

        return Scope(self._value(f), sibling, self.rules.context)

    # -- findings ----------------------------------------------------------------

    def findings(self, f: Field, staged: bool = True) -> list[_Finding]:
        """Every rule of the field, first stage first; a rule in the second stage is
        broken only where the first stage is not.  To learn only *whether* something
        is broken, the stages need not be told apart (``staged=False``)."""
        branches = f.branches()
        if branches is not None:
            merged = f.merged()
            if merged is not None:
                return self._merged_findings(f, merged, staged)
            condition, then, otherwise = branches
            holds = condition.holds(self._scope(f))
            return [
                *self._guarded(self.findings(then, staged), holds),
                *self._guarded(self.findings(otherwise, staged), ~holds),
            ]
        first, second = self._first_stage(f), self._second_stage(f)
        if staged and first and second:
            second = self._guarded(second, ~reduce(or_, [x.broken for x in first]))
        return [*first, *second]

    def _merged_findings(self, f: Field, merged: Merged, staged: bool) -> list[_Finding]:
        """Findings of a field with conditions, as many as there are rules in all of them."""
        scope = self._scope(f)
        holds = [c.holds(scope) for c in f.conditions]

        def active(rule: Guarded, findings: Sequence[_Finding]) -> list[_Finding]:
            sides = [(rule.where, True)] if rule.where is not None else []
            sides += [(at, False) for at in rule.unless]
            for (i, side), wanted in sides:
                findings = self._guarded(findings, holds[i] if side == wanted else ~holds[i])
            return list(findings)

        bare = replace(merged.base, absent=None, allowed=(), denied=(), tests=())
        typed = self._first_stage(bare)
        first = list(typed)
        for rule in merged.absents:
            if rule.rule:
                first += active(rule, self._first_stage(replace(bare, absent=rule.rule))[len(typed) :])
        for rule in merged.listed:
            listed = replace(rule.rule, absent=None, tests=())
            first += active(rule, self._first_stage(listed)[len(typed) :])
        second = [
            x for rule in merged.rules for x in active(rule, self._second_stage(replace(bare, tests=(rule.rule,))))
        ]
        if staged and first and second:
            second = self._guarded(second, ~reduce(or_, [x.broken for x in first]))
        return [*first, *second]

    def _first_stage(self, f: Field) -> list[_Finding]:
        scope, value = self._scope(f), self._value(f)
        raw = quoted(_RAW + f.name)
        missing = value.isNull()
        found = []

        def add(rule: str, broken: Column, template: str, **params) -> None:
            message = render(template, {"path": f.label, **params}, scope)
            found.append(_Finding(f.name, rule, broken, message))

        if _can_fail(f):
            invalid = "Invalid Date" if f.kind == "date" else "NaN"
            mistyped = raw.isNotNull() & value.isNull()
            add("type", mistyped, f.type_message, type=f.kind, invalid=invalid, value=raw)
            missing = missing & raw.isNull()
        if f.absent:
            add(f.absent[0], missing, f.absent[1])
        if f.allowed:
            hit = self._among(f, f.allowed, scope)
            add("one_of", value.isNotNull() & ~hit, f.allowed_message, values=_listed(f.allowed))
        if f.denied:
            hit = self._among(f, f.denied, scope)
            add("not_one_of", value.isNotNull() & hit, f.denied_message, values=_listed(f.denied))
        return found

    def _among(self, f: Field, values: Sequence[Any], scope: Scope) -> Column:
        """The cell equals a listed value, of its own type; references go row by row."""
        dtype = self.prepared.schema[_CAST + f.name].dataType
        fixed = [v for v in values if not isinstance(v, Ref) and comparable(v, dtype)]
        tests = [scope.value.isin(*fixed)] if fixed else []
        tests += [scope.value.eqNullSafe(v.column(scope)) for v in values if isinstance(v, Ref)]
        return F.coalesce(reduce(or_, tests), F.lit(False)) if tests else F.lit(False)

    def _second_stage(self, f: Field) -> list[_Finding]:
        scope, value = self._scope(f), self._value(f)
        found = []
        for t in f.tests:
            broken = ~F.coalesce(t.check(scope), F.lit(False))
            if t.skip_absent:
                broken = value.isNotNull() & broken
            params = {"path": f.label, "value": value, **dict(t.params)}
            found.append(_Finding(f.name, t.name, broken, render(t.message, params, scope)))
        return found

    @staticmethod
    def _guarded(findings: Sequence[_Finding], test: Column) -> list[_Finding]:
        return [_Finding(x.field, x.rule, test & x.broken, x.message) for x in findings]

    def all_findings(self) -> list[_Finding]:
        return [x for f in self.rules.fields for x in self.findings(f)]

    def broken_by_rule(self) -> dict[tuple[str, str], Column]:
        """Where each rule of each field is broken, whichever branch it stands in."""
        listed: dict[tuple[str, str], Column] = {}
        for x in self.all_findings():
            key = (x.field, x.rule)
            listed[key] = listed[key] | x.broken if key in listed else x.broken
        return listed

    # -- results ------------------------------------------------------------------

    def is_valid(self) -> Column:
        found = [x for f in self.rules.fields for x in self.findings(f, staged=False)]
        tests = [~x.broken for x in found]
        return reduce(and_, tests) if tests else F.lit(True)

    def violations(self) -> Column:
        # Joined lists stay inside generated code; filtering nulls out of one array
        # would have every rule interpreted.
        entries = [x.entry() for x in self.all_findings()]
        found = F.concat(F.array().cast(_LIST), *entries)
        return F.slice(found, 1, 1) if self.rules.abort_early else found

    def valid_cells(self) -> dict[str, Column | None]:
        """New content of the columns of valid rows; None for a stripped column."""
        cells: dict[str, Column | None] = {}
        for f in self.rules.fields:
            root, *steps = f.name.split(".")
            if not steps:
                cells[root] = None if f.stripped else self._value(f)
                continue
            here = cells.get(root)
            here = quoted(root) if here is None else here
            path = ".".join(steps)
            cells[root] = (
                here.dropFields(path) if f.stripped else here.withField(path, self._value(f))
            )
        return cells


def annotate(df: DataFrame, rules: RecordRules) -> DataFrame:
    """The original rows with ``_valid`` and ``_violations``."""
    checker = Checker(df, rules)
    return _annotated(checker, checker.prepared)


def _annotated(checker: Checker, prepared: DataFrame) -> DataFrame:
    kept = [quoted(c) for c in checker.df.columns]
    checked = prepared.select(*kept, checker.violations().alias(VIOLATIONS))
    return checked.select(*kept, (F.size(VIOLATIONS) == 0).alias(VALID), quoted(VIOLATIONS))


def flag_rows(df: DataFrame, rules: RecordRules) -> DataFrame:
    """The original rows with ``_valid`` only, which is cheaper than the violations."""
    checker = Checker(df, rules)
    return checker.prepared.select(
        *[quoted(c) for c in df.columns], checker.is_valid().alias(VALID)
    )


def valid_rows(df: DataFrame, rules: RecordRules, strip_unknown: bool = False) -> DataFrame:
    """Rows without violations, with cast cells."""
    checker = Checker(df, rules)
    cells = checker.valid_cells()
    outputs = []
    for c in df.columns:
        if c in cells:
            if cells[c] is not None:
                outputs.append(cells[c].alias(c))
        elif not strip_unknown:
            outputs.append(quoted(c))
    return checker.prepared.filter(checker.is_valid()).select(*outputs)


def rejected_rows(df: DataFrame, rules: RecordRules) -> DataFrame:
    """Original rows with at least one violation, and the list of violations."""
    checker = Checker(df, rules)
    return checker.prepared.filter(~checker.is_valid()).select(
        *[quoted(c) for c in df.columns], checker.violations().alias(VIOLATIONS)
    )


def cast_rows(df: DataFrame, rules: RecordRules) -> DataFrame:
    """All rows with cells after transforms, cast and default, unchecked."""
    checker = Checker(df, rules)
    cells = checker.valid_cells()
    kept = [(c, cells[c] if c in cells else quoted(c)) for c in df.columns]
    return checker.prepared.select(*[v.alias(c) for c, v in kept if v is not None])


def report(df: DataFrame, rules: RecordRules) -> DataFrame:
    """``(pos, field, rule, failures)`` of every rule, those never broken included.

    One pass, one partial count per rule and task; nothing else is shuffled.
    """
    checker = Checker(df, rules)
    broken = checker.broken_by_rule()
    if not broken:
        return small_frame(df.sparkSession, [], _REPORT)
    counted = checker.prepared.agg(*_counts(broken))
    rows = [
        F.struct(
            F.lit(i + 1).cast("bigint").alias("pos"),
            F.lit(f).alias("field"),
            F.lit(rule).alias("rule"),
            F.col(f"n{i}").alias("failures"),
        )
        for i, (f, rule) in enumerate(broken)
    ]
    return counted.select(F.inline(F.array(*rows)))


def write_validated(
    df: DataFrame, rules: RecordRules, folder: str, mode: str = "errorifexists"
) -> DataFrame:
    """Write the annotated rows once and return the report, all in one pass.

    Valid rows land in ``_valid=true`` and rejected ones, with their violations, in
    ``_valid=false``.  The report's counts are taken while the rows are written, so
    a table too large to read three times is read once.
    """
    checker = Checker(df, rules)
    broken = checker.broken_by_rule()
    seen = Observation()
    observed = checker.prepared
    if broken:
        observed = observed.observe(seen, *_counts(broken))
    _annotated(checker, observed).write.mode(mode).partitionBy(VALID).parquet(folder)
    counts = seen.get if broken else {}
    rows = [(i + 1, f, rule, counts[f"n{i}"]) for i, (f, rule) in enumerate(broken)]
    return small_frame(df.sparkSession, rows, _REPORT)


def read_validated(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written by :func:`write_validated`; a filter on ``_valid`` reads one side only.

    Folder names give no booleans, so the flag is cast back.
    """
    return spark.read.parquet(folder).withColumn(VALID, F.col(VALID).cast("boolean"))


def _counts(broken: dict[tuple[str, str], Column]) -> list[Column]:
    return [F.count_if(test).alias(f"n{i}") for i, test in enumerate(broken.values())]


def first_messages(violations: Column) -> Column:
    """Map from field to its first message."""
    fields = F.array_distinct(F.transform(violations, lambda v: v["field"]))

    def first(name: Column) -> Column:
        return F.get(F.filter(violations, lambda v: v["field"] == name), F.lit(0))["message"]

    return F.map_from_arrays(fields, F.transform(fields, first))


def validate(df: DataFrame, rules: RecordRules, strip_unknown: bool = False) -> Outcome:
    """Split a table into valid and rejected rows and count failures per rule."""
    return Outcome(
        valid_rows(df, rules, strip_unknown), rejected_rows(df, rules), report(df, rules)
    )


def all_valid(df: DataFrame, rules: RecordRules) -> bool:
    """Whether no row breaks a rule; stops at the first that does."""
    checker = Checker(df, rules)
    return checker.prepared.filter(~checker.is_valid()).isEmpty()


def require_valid(df: DataFrame, rules: RecordRules) -> DataFrame:
    """The cast rows, or :class:`InvalidRecords` with the failures of every broken rule."""
    failures = {(r["field"], r["rule"]): r["failures"] for r in report(df, rules).collect()}
    failures = {rule: n for rule, n in failures.items() if n}
    if failures:
        raise InvalidRecords(failures)
    return cast_rows(df, rules)


def unknown_keys(json_text: Column, declared: Sequence[str]) -> Column:
    """Keys of a JSON object that no rule names, in their order; empty for no object."""
    keys = F.coalesce(F.json_object_keys(json_text), F.array().cast("array<string>"))
    return F.array_except(keys, F.array(*[F.lit(d) for d in declared]).cast("array<string>"))


def unknown_message(keys: Column, path: str = "this", exact: bool = False) -> Column:
    """What is said about unknown keys, in the words of the plain or the exact rule."""
    rule, name = ("exact", "properties") if exact else ("no_unknown", "unknown")
    before, _, after = MESSAGES[rule].replace("${path}", path).partition("${" + name + "}")
    return F.concat(F.lit(before), F.array_join(keys, ", "), F.lit(after))


def _can_fail(f: Field) -> bool:
    """Whether a cell may not cast; every value has a text."""
    return f.kind not in ("string", "mixed")


def _listed(values: Sequence[Any]) -> str:
    return ", ".join(f"Ref({v.key})" if isinstance(v, Ref) else str(v) for v in values)
