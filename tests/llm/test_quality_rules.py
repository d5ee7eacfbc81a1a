from __future__ import annotations

import re
from collections import Counter

import oracle
import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries, quality_rules
from tablewright.llm.quality_rules import Rule

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The counts of one text, windows by a dictionary."""
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    listed = {*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_stop_words": sum(w.strip(".,;:?\"'()") in listed for w in words),
    }


def check(row, text):
    want = brute(text)
    assert {k: row[k] for k in want} == want
    failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
    n = max(1, want["n_words"])
    good = (
        3 <= want["word_chars"] / n <= 14
        and want["n_symbols"] / n <= 0.1
        and want["n_stop_words"] / n >= 0.06
        and want["n_dup_lines"] <= 0.4 * want["n_lines"]
    )
    assert row.base_failed == failed and row.kept == (good and not failed)


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = queries.op12_quality_rules(spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        check(r, texts[r.doc_id])


def test_query_equals_its_sql(spark, tables):
    sql = queries.ORACLES["op12_quality_rules"]
    assert oracle.difference(queries.op12_quality_rules(spark, tables), oracle.connect(tables), sql) is None


PROSE = "The house of the king was old and it stood on a hill by the sea . ".split()


def prose(n, seed=1):
    """Words that repeat no window: stop words between numbered ones."""
    return " ".join(f"{PROSE[i % 6]} w{seed}x{i}" for i in range(n // 2))


TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c ",
    "a b c",
    "a b c a b c",
    "a a a a",
    "a a a",
    "x y z x y z x y z " * 30,
    prose(50),
    prose(49),
    prose(60) + "\n" + prose(60),
    "\n".join([prose(60)] * 2 + [prose(80, 2), prose(70, 3)]),
    prose(100) + " | # % & $ * < > |" * 3,
    "ДАННЫЕ и 資料 𝒳𝒴 " * 40 + prose(60),
    " nbsp is no space   here " + prose(80),
    "THE! AND! OF! " * 40,
    prose(90).replace(" ", "\n"),
    "averyveryverylongwordwithoutend" * 3 + " " + " ".join(f"verylongwordwithoutanyend{i}" for i in range(60)),
    "w " * 200_000,
    " ".join(f"the w{i % 70_000}" for i in range(100_000)),
]


def test_edges(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(8, TEXTS[8]), (None, TEXTS[8])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    # Clashing names of other columns do no harm.
    for name in ("_words", "_text", "_lines", "n_words", "kept"):
        frame = frame.withColumn(name, F.lit("x"))
    got = quality_rules.judge(frame).collect()
    assert len(got) == len(rows)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        check(r, TEXTS[8 if r.doc_id is None else r.doc_id])
    assert quality_rules.judge(frame.where("false")).collect() == []
    by_id = {r.doc_id: r for r in got}
    assert by_id[8].kept and by_id[8].failed_rules == [] and not by_id[9].kept
    assert by_id[0].failed_rules == ["enough_words"] or "enough_words" in by_id[0].failed_rules


@pytest.mark.parametrize("place_bits", [24, 61, 4])  # as is, hashes that clash, lists too long
@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_windows_of_any_length(spark, window, place_bits):
    import random

    random.seed(window)
    lists = [[random.choice("abc") for _ in range(n)] for n in (0, 1, 2, 3, 4, 5, 8, 20, 60)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, words array<string>")
    got = {r.i: r.n for r in frame.select("i", quality_rules.repeated_words(F.col("words"), window, place_bits).alias("n")).collect()}
    for i, words in enumerate(lists):
        grams = [tuple(words[k : k + window]) for k in range(len(words) - window + 1)]
        often = Counter(grams)
        assert got[i] == len({k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(window)})


def test_the_table_is_compiled_into_one_projection(spark, tables):
    plan = queries.op12_quality_rules(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("regexp_extract_all(") == 1  # words are split once
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_own_rules(spark):
    rules = [Rule("short", "n_words", None, most=3), Rule("symbols", "n_symbols", "n_words", most=0.5)]
    frame = spark.createDataFrame([(1, "a b"), (2, "a b # #"), (3, "# a")], "doc_id int, text string")
    got = {r.doc_id: r.failed_rules for r in quality_rules.judge(frame, rules).collect()}
    assert got == {1: [], 2: ["short"], 3: []}
