"""Rules, validation and ready-made rule sets on small frames."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import rulesets
from tablewright.operators.rules import Field, InvalidRecords, RecordRules, Ref, RuleError
from tablewright.operators.validate import (
    VALID,
    VIOLATIONS,
    all_valid,
    annotate,
    cast_rows,
    first_messages,
    read_validated,
    rejected_rows,
    report,
    require_valid,
    unknown_keys,
    unknown_message,
    valid_rows,
    validate,
    write_validated,
)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).coalesce(1)


def broken(df, rules):
    """Rule names per row, in order."""
    rules = RecordRules((rules,)) if isinstance(rules, Field) else rules
    rows = annotate(df, rules).collect()
    for r in rows:
        assert r[VALID] == (not r[VIOLATIONS])
    return [[v["rule"] for v in r[VIOLATIONS]] for r in rows]


def texts(spark, *values):
    return frame(spark, [(v,) for v in values], "v string")


def test_required_tells_absent_from_empty(spark):
    df = texts(spark, None, "", "x")
    assert broken(df, Field("v").required()) == [["required"], ["required"], []]
    kept = RecordRules((Field("v").min(1).required(),), empty_as_absent=False)
    assert broken(df, kept) == [["required"], ["min", "required"], []]


def test_presence_rules(spark):
    df = texts(spark, None, "x")
    assert broken(df, Field("v")) == [[], []]
    assert broken(df, Field("v").non_nullable()) == [["not_null"], []]
    assert broken(df, Field("v").defined()) == [["defined"], []]
    assert broken(df, Field("v").required().not_required()) == [[], []]
    assert broken(df, Field("v").non_nullable().nullable()) == [[], []]


def test_length_counts_utf16_units(spark):
    df = texts(spark, "abc", "\U0001f600a", "\U0001f600", None)
    assert broken(df, Field("v").length(3)) == [[], [], ["length"], []]
    assert broken(df, Field("v").min(3).max(3)) == [[], [], ["min"], []]
    assert broken(df, Field("v").max(9).max(2)) == [["max"], ["max"], [], []]  # the last one counts


def test_pattern_is_searched_for(spark):
    df = texts(spark, "xay", "b", "")
    rules = RecordRules((Field("v").matches("a"),), empty_as_absent=False)
    assert broken(df, rules) == [[], ["matches"], ["matches"]]
    lenient = RecordRules((Field("v").matches("a", exclude_empty=True),), empty_as_absent=False)
    assert broken(df, lenient) == [[], ["matches"], []]


def test_datetime_options(spark):
    df = texts(spark, "2024-01-01T10:20:30Z", "2024-01-01T10:20:30.12Z", "2024-01-01T10:20:30+01", "2024-01-01")
    assert broken(df, Field("v").datetime()) == [[], [], ["datetime_offset"], ["datetime", "datetime_offset"]]
    assert broken(df, Field("v").datetime(allow_offset=True)) == [[], [], [], ["datetime"]]
    precise = Field("v").datetime(allow_offset=True, precision=2)
    assert broken(df, precise) == [
        ["datetime_precision"], [], ["datetime_precision"], ["datetime", "datetime_precision"],
    ]


def test_transforms_come_before_tests_unless_strict(spark):
    df = texts(spark, " Ab ", "ab")
    rule = Field("v").trim().lowercase()
    assert broken(df, rule) == [[], []]
    assert [r["v"] for r in valid_rows(df, RecordRules((rule,))).collect()] == ["ab", "ab"]
    assert broken(df, rule.strict()) == [["trim", "case"], []]
    assert broken(df, rule.uppercase().strict()) == [["trim", "case"], ["case"]]


def test_defaults(spark):
    df = texts(spark, None, "", "x")
    for rule, want in ((Field("v").default("d"), "d"), (Field("v").ensure(), "")):
        rows = cast_rows(df, RecordRules((rule,))).collect()
        assert [r["v"] for r in rows] == [want, want, "x"]


def test_a_misfit_is_wrong_even_with_a_default(spark):
    df = texts(spark, None, "7", "x")
    rule = Field("v", "int").default(1).required()
    assert broken(df, rule) == [[], [], ["type"]]
    assert [r["v"] for r in valid_rows(df, RecordRules((rule,))).collect()] == [1, 7]


def test_allowed_and_denied_values(spark):
    df = frame(spark, [("a", "a"), ("b", "a"), ("c", "c"), (None, "a")], "v string, w string")
    assert broken(df, Field("v").one_of(["a", "b"])) == [[], [], ["one_of"], []]
    assert broken(df, Field("v").one_of(["b", Ref("w")])) == [[], [], [], []]
    assert broken(df, Field("v").not_one_of(["b", Ref("w")])) == [
        ["not_one_of"], ["not_one_of"], ["not_one_of"], [],
    ]
    moved = Field("v").one_of(["a", "b"]).not_one_of(["b"])
    assert (moved.allowed, moved.denied) == (("a",), ("b",))


def test_values_match_within_their_type_only(spark):
    df = frame(spark, [(1, "1"), (2, "2")], "n int, s string")
    assert broken(df, Field("n", "int").one_of([1, "2"])) == [[], ["one_of"]]
    assert broken(df, Field("s").not_one_of([1, "2"])) == [[], ["not_one_of"]]


def test_the_first_violation_may_be_enough(spark):
    rules = RecordRules((Field("v").min(3).matches("x"),), abort_early=True)
    assert broken(texts(spark, "a", "xxx"), rules) == [["min"], []]


def test_a_whole_table_passes_or_fails(spark):
    rules = RecordRules((Field("v").trim().max(2).required(),))
    good, bad = texts(spark, " a ", "b"), texts(spark, "a", "abc", "abcd", None)
    assert all_valid(good, rules) and not all_valid(bad, rules)
    assert [r["v"] for r in require_valid(good, rules).collect()] == ["a", "b"]
    with pytest.raises(InvalidRecords) as failed:
        require_valid(bad, rules)
    assert failed.value.failures == {("v", "required"): 1, ("v", "max"): 2}


def test_dates(spark):
    df = texts(spark, "2024-01-10", "2024-01-11T00:00:00Z", "2023-12-31", "nope", None)
    rule = Field("v", "date").min("2024-01-01").max("2024-01-10")
    assert broken(df, rule) == [[], ["max"], ["min"], ["type"], []]
    row = annotate(df.filter("v = 'nope'"), RecordRules((rule,))).first()
    assert row[VIOLATIONS][0]["message"] == (
        "v must be a `date` type, but the final value was: `Invalid Date`"
        ' (cast from the value `"nope"`).'
    )
    spans = frame(spark, [("2024-01-02", "2024-01-01"), ("2024-01-02", "2024-01-03")], "b string, a string")
    ends = RecordRules((Field("a", "date"), Field("b", "date").min(Ref("a"))))
    assert broken(spans, ends) == [[], ["min"]]


def test_custom_tests_and_references(spark):
    df = frame(spark, [(1, 2, None), (5, 2, 3)], "v int, w int, x int")
    below = Field("v", "int").test(
        "below", "${path} must be below ${top}", lambda s: s.value < s.resolve(Ref("w")), top=Ref("w")
    )
    assert broken(df, below) == [[], ["below"]]
    said = annotate(df, RecordRules((below.titled("V"),))).collect()[1][VIOLATIONS][0]["message"]
    assert said == "V must be below 2"
    limit = Field("v", "int").test("cap", check=lambda s: s.value <= s.resolve(Ref("$cap")))
    assert broken(df, RecordRules((limit,), context={"cap": 3})) == [[], ["cap"]]
    doubled = Ref("w", map=lambda c: c * 3)
    assert broken(df, Field("v", "int").one_of([doubled, 1])) == [[], ["one_of"]]
    seen = Field("x", "int").test("known", check=lambda s: s.value > 0, skip_absent=False)
    assert broken(df, seen) == [["known"], []]
    unknown = Field("v", "int").test("odd", check=lambda s: s.sibling("x") > 0)
    assert broken(df, unknown) == [["odd"], []]  # neither true nor false is not good
    with pytest.raises(RuleError):
        Field("v").test("no check")


def test_an_exclusive_test_replaces_its_namesake():
    f = Field("v").test("t", "one", lambda s: s.value == "a").test("t", "two", lambda s: s.value == "b")
    assert len(f.tests) == 2
    f = f.test("t", "three", lambda s: s.value == "c", exclusive=True)
    assert [t.message for t in f.tests] == ["three"]


def test_conditions(spark):
    df = frame(spark, [("R", "F"), ("R", "O"), ("A", "O"), ("A", "X"), (None, "X")], "flag string, v string")
    rule = Field("v").when(
        "flag", "R", then=lambda f: f.one_of(["F"]), otherwise=lambda f: f.not_one_of(["X"])
    )
    assert broken(df, rule) == [[], ["one_of"], [], ["not_one_of"], ["not_one_of"]]
    either = Field("v").when(
        ["flag", "v"], lambda flag, v: (flag == "A") & (v == "O"), then=lambda f: f.length(2)
    )
    assert broken(df, either) == [[], [], ["length"], [], []]
    twice = Field("v").when("flag", "R", then=lambda f: f.min(2)).when("v", "O", then=lambda f: f.max(0))
    assert broken(df, twice) == [["min"], ["min", "max"], ["max"], [], []]
    changed = Field("v").when("flag", "R", then=lambda f: f.transform(F.lower))
    assert [r["v"] for r in cast_rows(df, RecordRules((changed,))).collect()] == ["f", "o", "O", "X", "X"]
    with pytest.raises(RuleError):
        Field("v").when("flag", "R")


def test_conditions_must_not_go_round(spark):
    df = frame(spark, [("a", "b")], "a string, b string")
    a = Field("a").when("b", "x", then=lambda f: f.trim())
    b = Field("b").when("a", "x", then=lambda f: f.trim())
    with pytest.raises(RuleError):
        annotate(df, RecordRules((a, b)))


def test_second_stage_waits_for_the_first(spark):
    df = texts(spark, "zz", "a", "abc")
    rule = Field("v").one_of(["a", "abc"]).min(2).max(2)
    assert broken(df, rule) == [["one_of"], ["min"], ["max"]]


def test_violations_stand_in_field_order_with_messages(spark):
    df = frame(spark, [("", "toolong"), ("x", "ok")], "a string, b string")
    rules = RecordRules((Field("b").max(3).matches("^x", "b is odd"), Field("a").required("give a")))
    first, second = annotate(df, rules).select(
        VIOLATIONS, first_messages(F.col(VIOLATIONS)).alias("m")
    ).collect()
    assert [tuple(v) for v in first[VIOLATIONS]] == [
        ("b", "max", "b must be at most 3 characters"),
        ("b", "matches", "b is odd"),
        ("a", "required", "give a"),
    ]
    assert first["m"] == {"b": "b must be at most 3 characters", "a": "give a"}
    assert second["m"] == {"b": "b is odd"}


def test_outcome_splits_the_table_and_the_report_counts(spark, folder):
    df = spark.range(1000).select(
        F.col("id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit(" n"), "id")).alias("name"),
        F.when(F.col("id") % 5 == 0, "x").otherwise(F.col("id").cast("string")).alias("size"),
    )
    rules = RecordRules((Field("name").trim().max(3).required(), Field("size", "int")))
    out = validate(df, rules)
    valid, rejected = out.valid.collect(), out.rejected.collect()
    assert sorted(r["id"] for r in valid + rejected) == list(range(1000))
    for r in valid:
        assert r["name"] == f"n{r['id']}" and r["size"] == r["id"] < 100
    assert all(r["size"] == ("x" if r["id"] % 5 == 0 else str(r["id"])) for r in rejected)
    counts = {(r["field"], r["rule"]): r["failures"] for r in out.report.collect()}
    assert counts == {
        ("name", "required"): 334,
        ("name", "trim"): 0,
        ("name", "max"): sum(i % 3 > 0 and i > 99 for i in range(1000)),
        ("size", "type"): 200,
    }
    listed = sum(len(r[VIOLATIONS]) for r in rejected)
    assert listed == sum(counts.values())
    written = write_validated(df, rules, folder + "/out")
    assert sorted(written.collect()) == sorted(out.report.collect())
    back = read_validated(spark, folder + "/out")
    assert back.filter(VALID).count() == len(valid) and back.count() == 1000


def test_nested_fields_and_stripping(spark):
    df = spark.sql("select 1 id, named_struct('b', ' X ', 'c', 5) a, 'gone' s, 'new' u")
    rules = RecordRules(
        (Field("id", "int"), Field("a.b").trim().lowercase().required(), Field("s").strip())
    )
    row = valid_rows(df, rules, strip_unknown=True).first()
    assert row.asDict(True) == {"id": 1, "a": {"b": "x", "c": 5}}
    assert rules.unknown_columns(df) == ["u"]
    inner = RecordRules((Field("a.c", "int").strip(),))
    assert valid_rows(df, inner).first().asDict(True)["a"] == {"b": " X "}
    with pytest.raises(RuleError):
        annotate(df, RecordRules((Field("a.z"),)))


def test_rule_lists_combine(spark):
    a, b, c = Field("a").required(), Field("b").max(3), Field("x.c").required()
    rules = RecordRules((a, b, c))
    assert rules.pick(["b", "zz"]).names == ["b"]
    assert rules.omit(["b"]).names == ["a", "x.c"]
    assert rules.shape(Field("b").max(9), Field("d")).names == ["a", "b", "x.c", "d"]
    assert rules.concat(RecordRules((Field("b").max(5),))).names == ["b", "a", "x.c"]
    assert [f.absent is None for f in rules.partial().fields] == [True, True, False]
    assert all(f.absent is None for f in rules.deep_partial().fields)
    with pytest.raises(RuleError):
        RecordRules((a, a))
    listed = [tuple(r)[1:] for r in rules.rules_frame(spark).orderBy("pos").collect()]
    assert listed[:3] == [("a", "type", "type=string"), ("a", "required", ""), ("b", "type", "type=string")]
    assert listed[3] == ("b", "max", "max=3")


def test_rules_fit_their_fields():
    for wrong in (lambda: Field("v", "int").min(1), lambda: Field("v", "date").email()):
        with pytest.raises(RuleError):
            wrong()
    with pytest.raises(RuleError):
        Ref(" ")


def test_unknown_keys_of_json_records(spark):
    df = texts(spark, '{"a":1,"b":2,"c":3}', '{"a":1}', "[1]", "bad", None)
    keys = unknown_keys(F.col("v"), ["a"])
    rows = df.select(keys.alias("k"), unknown_message(keys).alias("m")).collect()
    assert [r["k"] for r in rows] == [["b", "c"], [], [], [], []]
    assert rows[0]["m"] == "this field has unspecified keys: b, c"
    said = df.select(unknown_message(keys, "r", exact=True).alias("m")).first()["m"]
    assert said == "r object contains unknown properties: b, c"


LONG = "x" * 253


def test_register_rules(spark):
    schema = "firstname string, lastname string, email string, company string, password string"
    rows = [
        ("A", "B", "a@b", None, "0123456789"),
        ("", None, "a@", None, " pw"),
        ("A", "B", LONG + "@y", "C", "01234567890"),
        ("A" * 256, "B", LONG + "z@y", "C", "pw "),
        ("A", "B", "", "", ""),
    ]
    assert broken(frame(spark, rows, schema), rulesets.register_rules()) == [
        [],
        ["required", "required", "email", "no-leading-trailing-whitespace"],
        ["max"],
        ["max", "max", "no-leading-trailing-whitespace"],
        ["required", "required"],
    ]


def test_other_rule_sets(spark):
    pairs = frame(spark, [("a", "a"), ("a", "b"), ("a", None), (None, None)], "password string, confirmPassword string")
    assert broken(pairs, rulesets.reset_rules()) == [
        [], ["confirmPassword"], ["required"], ["required", "required"],
    ]
    codes = frame(spark, [("1234",), ("123",), (None,)], "otp string")
    assert broken(codes, rulesets.code_rules()) == [[], ["length"], ["required"]]
    logins = frame(spark, [("a@b", "x"), ("a", None)], "email string, password string")
    assert broken(logins, rulesets.login_rules()) == [[], ["email", "required"]]
    assert broken(logins, rulesets.forgot_rules()) == [[], ["email"]]


def test_rejected_rows_keep_what_came(spark):
    rows = rejected_rows(texts(spark, " x "), RecordRules((Field("v").trim().min(5),))).collect()
    assert [r["v"] for r in rows] == [" x "]


def test_report_lists_rules_that_never_fail(spark):
    rows = report(texts(spark, "x"), RecordRules((Field("v").required().max(3),))).collect()
    assert [(r["pos"], r["rule"], r["failures"]) for r in rows] == [(1, "required", 0), (2, "max", 0)]
    assert report(texts(spark, "x"), RecordRules(())).count() == 0
