from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tablewright.llm import queries, simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, reach=2):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= reach:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_query_against_all_pairs(spark, tables):
    got = {r.doc_id: r for r in queries.op1_simhash_near_duplicates(spark, tables).collect()}
    docs = sorted(spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect())
    prints = [brute_print(d.text) for d in docs]
    roots = brute_components(prints)
    assert len(got) == len(docs)
    for i, d in enumerate(docs):
        assert got[d.doc_id].fingerprint == f"{prints[i]:016x}"
        assert got[d.doc_id].component_id == docs[roots[i]].doc_id


@pytest.mark.parametrize("crowd", [2, 64])
def test_dense_groups_lose_no_link(spark, crowd):
    rng = np.random.default_rng(3)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    for base in prints[:6]:
        at = base
        for _ in range(25):  # a chain of copies, one to three bits apart
            for _ in range(int(rng.integers(1, 4))):
                at ^= 1 << int(rng.integers(0, 63))
            prints.append(at)
    rows = [(p,) for p in prints]
    frame = spark.createDataFrame(rows, "fp long").repartition(3)
    met = frame.mapInArrow(simhash._grid_points, "point long, fp long")
    met = met.repartition("point").sortWithinPartitions("point", "fp")
    pairs = met.mapInArrow(simhash._links(2, crowd), "a long, b long").collect()
    near = {
        (a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2
    }
    found = {(min(r), max(r)) for r in map(tuple, pairs) if r[0] != r[1]}
    crowded = {r.a for r in pairs if r.a == r.b}
    assert found <= near
    assert all(p in found or (p[0] in crowded and p[1] in crowded) for p in near)


def test_crowds_are_resolved_by_bits(spark):
    texts = [(i, "one two three four five six seven eight " + "x" * (i % 7)) for i in range(60)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    plain = simhash.near_duplicates(frame).collect()
    crowded = simhash.near_duplicates(frame, crowd=1).collect()
    assert sorted(plain) == sorted(crowded)


def test_edges(spark):
    rows = [
        (5, None, "a", 1),
        (3, "", "a", 2),
        (9, " \t\n ", None, 3),
        (None, "Only two", "a", 4),
        (7, "only TWO", "b", 5),
        (7, "only TWO", "b", 5),
        (8, "long " * 300_000, "b", 6),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp long")
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(frame).collect()]
    assert len(got) == 7
    assert {g[2] for g in got if g[0] in (5, 3, 9)} == {3}
    assert {g[1] for g in got if g[0] in (5, 3, 9)} == {0}
    assert [g[2] for g in got if g[0] in (None, 7)] == [7, 7, 7]
    assert simhash.near_duplicates(frame.where("false")).collect() == []


def test_long_text_in_chunks():
    text = " ".join(f"w{i % 977}" for i in range(400_000))
    words = text.encode().split()
    hashes = simhash._hashes(words, 3)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    want = sum(1 << b for b in range(64) if 2 * bits[b] > len(hashes))
    assert simhash.fingerprint(text.encode()) == want
