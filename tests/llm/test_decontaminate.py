from __future__ import annotations

import random

from pyspark.sql import functions as F

from tablewright.llm import decontaminate, queries


def grams(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items, threshold=0.8):
    out = {}
    for item_id, item in items:
        n = min(5, len((item or "").encode().split()))
        wanted = grams(item, n) if n else set()
        for doc_id, text in docs:
            if wanted and doc_id is not None and item_id is not None:
                shared = len(wanted & grams(text, n))
                if shared >= threshold * len(wanted):
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), (0, 0)), (shared, len(wanted)))
    return {(*k, v[1], v[0]) for k, v in out.items()}


def test_query_finds_all(spark, tables):
    got = queries.op9_benchmark_decontamination(spark, tables).drop("containment").collect()
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()
    docs = [tuple(d) for d in docs]
    want = brute(docs, [tuple(i) for i in items])
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_threshold_is_met_exactly(spark):
    rng = random.Random(5)
    items, docs = [], []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 90))]
        items.append((i, " ".join(words)))
        for j in range(6):
            part = [w if rng.random() > 0.02 * j else "changed" for w in words]
            filler = [f"f{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 400))]
            docs.append((len(docs), " ".join(filler + [w.upper() for w in part] + filler[::-1])))
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).drop("containment")
    want = brute(docs, items)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 60


def test_sketches_cannot_miss():
    for bound in range(1, 200):
        for count in range(1, bound + 1):
            # A contained item misses fewer hashes than the sketch (or the whole item) has.
            needed = -(-4 * count // 5)
            assert min(decontaminate.sketch_length(bound, 0.8), count) > count - needed


def test_edges(spark):
    items = [(1, "one two"), (2, ""), (3, None), (None, "a b c d e f"), (4, "a b c d e f g"), (4, "a b c d e f g")]
    long = "z " * 200_000 + "a b c d e f g " + "y " * 200_000
    docs = [(1, "x ONE\ttwo"), (2, None), (3, ""), (4, long), (4, long), (None, long), (5, "one"), (6, "a b c d e")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit("k"))
    wanted = spark.createDataFrame(items, "item_id long, text string").withColumn("count", F.lit(1))
    got = {tuple(r)[:4] for r in decontaminate.contaminated(frame, wanted).collect()}
    assert got == {(1, 1, 1, 1), (4, 4, 3, 3)}
    assert decontaminate.contaminated(frame.where("false"), wanted).collect() == []
    assert decontaminate.contaminated(frame, wanted.where("false")).collect() == []
