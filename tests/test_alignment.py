"""Shifted rows against every possible alignment."""

from __future__ import annotations

import random
import re

from tablewright.sources import alignment
from tablewright.sources.alignment import Header, align, aligned

SHAPES = [re.compile(p) for p in ("[0-9]+", "[a-z]+", "[0-9]+", "[A-Z]+")]


def cheapest(cells, shapes):
    """The least cost of all ways to lay cells under headers in order."""
    if not shapes:
        return sum(alignment.EXTRA for c in cells if c)
    if not cells:
        return alignment.ENDED * len(shapes)
    fits = not cells[0] or shapes[0].fullmatch(cells[0])
    return min(
        cheapest(cells[1:], shapes[1:]) + (0 if fits else alignment.MISFIT),
        cheapest(cells, shapes[1:]) + alignment.LOST,
        cheapest(cells[1:], shapes) + (alignment.EXTRA if cells[0] else 1),
    )


def test_the_cheapest_way():
    random.seed(6)
    for _ in range(400):
        cells = [random.choice(["1", "22", "ab", "C", "", None, "?"]) for _ in range(random.randrange(7))]
        placed, cost, extra = align(cells, SHAPES)
        assert len(placed) == 4 and cost == cheapest(cells, SHAPES)
        kept = [c for c in cells if c]
        assert sorted([c for c in placed if c] + extra) == sorted(kept)


def test_faults():
    assert align(["1", "ab", "2", "C"], SHAPES) == (["1", "ab", "2", "C"], 0, [])
    assert align(["1", "2", "C"], SHAPES) == (["1", None, "2", "C"], 2, [])
    assert align(["1", "ab", "2"], SHAPES) == (["1", "ab", "2", None], 1, [])
    assert align(["1", "ab", "??", "2", "C"], SHAPES) == (["1", "ab", "2", "C"], 2, ["??"])
    assert align(["1", "ab", "x", "C"], SHAPES) == (["1", "ab", "x", "C"], 3, [])
    assert align(["", "ab", None, "C"], SHAPES) == ([None, "ab", None, "C"], 0, [])
    assert align([], SHAPES) == ([None] * 4, 4, [])
    # Two numbers, one of them too many: the first keeps its place.
    assert align(["1", "2", "ab", "3", "C"], SHAPES) == (["1", "ab", "3", "C"], 2, ["2"])


def test_rows_of_a_frame(spark):
    rows = [(1, ["1", "ab", "2", "C"]), (2, ["1", "2", "C"]), (3, None), (4, []), (5, ["1", "ab", "", None]), (6, ["7", "ab", "8", "C", "D"])]
    headers = [Header("a", "int"), Header("b", pattern="[a-z]+"), Header("c", "int"), Header("d", pattern="[A-Z]+")]
    frame = spark.createDataFrame(rows, "id int, cells array<string>")
    got = {r.id: r for r in aligned(frame, "cells", headers).collect()}
    for i, cells in rows:
        placed, cost, extra = align(cells or [], SHAPES)
        assert [got[i][h.name] for h in headers] == placed and got[i]._shift == cost and got[i]._extra == extra
    assert aligned(frame.where("false"), "cells", headers).collect() == []


def test_types_have_shapes():
    shape = {k: re.compile(v) for k, v in alignment.SHAPES.items()}
    assert all(shape["double"].fullmatch(x) for x in ("1", "-1.5", ".5", "2.", "1e9", "+3E-2")) and not shape["double"].fullmatch("1.2.3")
    assert shape["int"].fullmatch("-12") and not shape["int"].fullmatch("1.0")
    assert shape["date"].fullmatch("2020-01-02") and shape["boolean"].fullmatch("True") and shape["string"].fullmatch("any\nthing")


def test_columns_align_as_python_does(spark):
    random.seed(8)
    texts = ["1", "22", "ab", "C", "", None, "?", "é"]
    rows = [(i, [random.choice(texts) for _ in range(random.randrange(8))]) for i in range(300)]
    headers = [Header("a", "int"), Header("b", pattern="[a-z]+"), Header("c", "int"), Header("d", pattern="[A-Z]+")]
    found = aligned(spark.createDataFrame(rows, "id int, cells array<string>"), "cells", headers)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.id: r for r in found.collect()}
    for i, cells in rows:
        placed, cost, extra = align(cells, SHAPES)
        assert ([got[i][h.name] for h in headers], got[i]._shift, got[i]._extra) == (placed, cost, extra), cells
