"""The queries of this package's operators on the shared test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import context_tree, decontaminate, main_text, merkle, mixing, quality_rules, sharding, simhash, site_quality, suffix_dedup, topk_search, warc, whitening
from tablewright.llm.labelled_pages import PAGES
from tablewright.llm.shared import new_path
from tablewright.queries.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register the decorated function under its own name."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op3_kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return sharding.shard_documents(docs, sharding.text_dimensions(docs))


@query
def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_texts(table(spark, folder, "pages"), PAGES)


@query
def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op8_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = site_quality.fit(docs, table(spark, folder, "labels"))
    return site_quality.score(docs, model, F.col("source"), F.col("lang"))


@query
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.resolved_records(spark, path)


@query
def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op7_context_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    return context_tree.score_documents(table(spark, folder, "documents"))


@query
def op2_block_max_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = topk_search.search(docs, docs.where("doc_id % 50 = 0"))
    return found.withColumn("score", F.round("score", 6))


#: Rows whose id has a checksum that this divides are tampered with.
TAMPERED = 7


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    n_chars = F.col("n_chars")

    def leaf(chars: Column) -> Column:
        return merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), chars, F.col("text"))

    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    tampered = F.when(chosen, leaf(n_chars.cast("decimal(38,0)") + 1))
    manifest = merkle.build(docs, F.col("doc_id"), F.col("lang"), leaf(n_chars), carried=tampered)
    return merkle.verified(manifest, F.coalesce("carried", "leaf"))


@query
def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).drop("failed_rules")


@query
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def _apportion(parties: str, party: str, votes: str) -> str:
    """SQL of the seats of each party of a group ``g``, all open quotients ranked outright."""
    return f"""(
    WITH shared AS (
      SELECT *, sum({votes}) OVER (PARTITION BY g) AS whole,
             CASE WHEN sum({votes}) OVER (PARTITION BY g) > 0
                  THEN CAST(floor({votes} * seats / sum({votes}) OVER (PARTITION BY g) + 0.5) AS BIGINT) ELSE 0 END AS near
      FROM {parties}),
    opened AS (
      SELECT *, CAST(CASE WHEN whole > 0 THEN seats ELSE 0 END - sum(near) OVER (PARTITION BY g) AS BIGINT) AS open FROM shared),
    tried AS (
      SELECT g, {party}, open, step,
             {votes} / (2.0 * (CASE WHEN open > 0 THEN near + step ELSE near - step + 1 END) - 1) AS quotient
      FROM (SELECT *, unnest(range(1, CASE WHEN open > 0 THEN open ELSE least(-open, near) END + 1)) AS step
            FROM opened WHERE open <> 0)),
    moved AS (
      SELECT g, {party}, sum(sign(open)) AS moved
      FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY CASE WHEN open > 0 THEN -quotient ELSE quotient END,
                                         {party} NULLS LAST, step) AS place FROM tried)
      WHERE place <= abs(open) GROUP BY g, {party})
    SELECT opened.*, CAST(near + coalesce(moved, 0) AS BIGINT) AS quota
    FROM opened LEFT JOIN moved ON opened.g IS NOT DISTINCT FROM moved.g
                               AND opened.{party} IS NOT DISTINCT FROM moved.{party})"""


def _mix_sql() -> str:
    """The mix in SQL, with every window over whole tables."""
    seeded = f"md5(concat_ws('/', '{mixing.SEED}', CAST(doc_id AS VARCHAR)))"
    started = f"md5(concat_ws('/', '{mixing.SEED}', source, CAST(shard AS VARCHAR)))"
    whole_started = f"md5(concat_ws('/', '{mixing.SEED}', source))"

    def overlap(first: str, last: str) -> str:
        return f"greatest(0, least(high, {last}) - greatest(low, {first}))"

    low, middle, high = mixing.WEIGHTS
    sources = _apportion("wanted", "source", "target")
    shards = _apportion("parts", "shard", "ring")
    return f"""
    WITH sized AS (
      SELECT doc_id, source, {seeded} AS seeded,
             CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
      FROM documents),
    facts AS (
      SELECT CAST(sum(size) AS BIGINT) AS total, count(DISTINCT coalesce(source, '')) AS n FROM sized),
    scale AS (
      SELECT shards, greatest(1, total // (n * shards * {mixing.BLOCKS_PER_SHARD})) AS block
      FROM (SELECT *, least({mixing.MOST_SHARDS}, greatest(1, (total + {mixing.SHARD_TOKENS - 1})
                                                              // {mixing.SHARD_TOKENS})) AS shards FROM facts)),
    keyed AS (SELECT sized.*, CAST('0x' || substr(seeded, 1, 8) AS BIGINT) % shards AS shard FROM sized, scale),
    rings AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS ring FROM keyed GROUP BY ALL),
    turns AS (
      SELECT source, CAST(sum(ring) AS BIGINT) AS size,
             [{low}, {middle}, {high}][row_number() OVER (ORDER BY source NULLS LAST) % 3
                                        + CASE WHEN row_number() OVER (ORDER BY source NULLS LAST) % 3 = 0 THEN 3 ELSE 0 END] AS weight
      FROM rings GROUP BY source),
    ranked AS (SELECT *, size * {mixing.MOST_PASSES} / weight AS ratio FROM turns),
    levels AS (
      SELECT *, (sum(size) OVER () * {mixing.SHARE_PERCENT} - {100 * mixing.MOST_PASSES} * coalesce(sum(size) OVER
                  (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / 100.0
                / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM ranked),
    targets AS (
      SELECT source, size AS source_size, least(CAST(size * {mixing.MOST_PASSES} AS DOUBLE), coalesce(weight * CAST(
               (SELECT max(level) FROM levels WHERE level <= ratio) AS DOUBLE), CAST(size * {mixing.MOST_PASSES} AS DOUBLE))) AS target
      FROM levels),
    wanted AS (
      SELECT 1 AS g, targets.*, CAST(round(sum(target) OVER () / block) AS BIGINT) AS seats FROM targets, scale),
    parts AS (
      SELECT rings.source AS g, rings.shard, rings.ring, source_size, target, quota AS seats
      FROM rings JOIN {sources} AS s ON rings.source IS NOT DISTINCT FROM s.source),
    runs AS (
      SELECT g AS source, shard, ring, source_size, target, least(quota * block, ring * {mixing.MOST_PASSES}) AS run, block
      FROM {shards}, scale),
    judged AS (
      SELECT *, abs(sum(run) OVER (PARTITION BY source) - target) * 100 > target * {mixing.MOST_MISSED_PERCENT} AS one_ring,
             CAST(coalesce(sum(ring) OVER (PARTITION BY source ORDER BY shard
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM runs),
    started AS (
      SELECT source, shard, source_size, target,
             CASE WHEN one_ring THEN source_size ELSE ring END AS ring,
             CASE WHEN one_ring THEN CAST(round(target) AS BIGINT) ELSE run END AS run,
             CASE WHEN one_ring THEN CAST('0x' || substr({whole_started}, 1, 8) AS BIGINT) % greatest(1, source_size)
                  ELSE CAST('0x' || substr({started}, 1, 8) AS BIGINT) % greatest(1, ring // block) * block END AS start,
             CASE WHEN one_ring THEN before ELSE 0 END AS behind
      FROM judged),
    placed AS (
      SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY seeded, doc_id, size ROWS UNBOUNDED PRECEDING) AS high
      FROM keyed),
    joined AS (
      SELECT p.doc_id, p.source, p.size, s.source_size, s.target, behind + p.high - p.size AS low, behind + p.high AS high, s.ring, s.start,
             s.run // greatest(s.ring, 1) AS passes, s.run % greatest(s.ring, 1) AS rest
      FROM placed AS p JOIN started AS s ON p.source IS NOT DISTINCT FROM s.source AND p.shard = s.shard)
    SELECT doc_id, size, source_size, target, source,
           CAST(passes * size + {overlap('start', 'start + rest')} + {overlap('0', 'start + rest - ring')} AS BIGINT) AS taken
    FROM joined"""


ORACLES["op5_source_mix"] = _mix_sql()

ORACLES["op10_warc_revisits"] = f"""
    WITH paged AS (
      SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
    originals AS (SELECT html, max(page_id) AS original FROM paged WHERE size >= {warc.REVISIT_FROM} GROUP BY html)
    SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(paged.html) AS payload_digest,
           CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN original <> page_id THEN original END AS refers_to
    FROM paged LEFT JOIN originals ON paged.html = originals.html AND size >= {warc.REVISIT_FROM}"""


def _words(text: str) -> str:
    """SQL of the words of a text, lower-cased in A-Z only."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+')"


def _grams(words: str, size: str) -> str:
    """SQL of the distinct shingles of a list of words."""
    places = f"range(1, CAST(len({words}) - {size} + 2 AS BIGINT))"
    return f"list_distinct([array_to_string({words}[i : i + {size} - 1], ' ') for i in {places}])"


ORACLES["op9_benchmark_decontamination"] = f"""
    WITH items AS (SELECT item_id, {_words("text")} AS words FROM benchmark),
    sized AS (SELECT item_id, words, least(len(words), {decontaminate.SHINGLE_WORDS}) AS n FROM items WHERE len(words) > 0),
    wanted AS (SELECT item_id, n, unnest({_grams("words", "n")}) AS gram FROM sized),
    counted AS (SELECT item_id, n, count(*) AS item_shingles FROM wanted GROUP BY ALL),
    split AS (SELECT doc_id, {_words("text")} AS words FROM documents),
    held AS (
      SELECT DISTINCT doc_id, n, unnest({_grams("words", "n")}) AS gram
      FROM split, (SELECT DISTINCT n FROM sized) AS sizes WHERE len(words) >= n),
    met AS (
      SELECT doc_id, wanted.item_id, count(*) AS shared
      FROM held JOIN wanted ON held.n = wanted.n AND held.gram = wanted.gram GROUP BY ALL)
    SELECT doc_id, met.item_id, item_shingles, shared, shared / item_shingles AS containment
    FROM met JOIN counted ON met.item_id = counted.item_id
    WHERE shared >= {decontaminate.THRESHOLD} * item_shingles"""

ORACLES["op2_block_max_search"] = f"""
    WITH words AS (SELECT doc_id, unnest({_words("text")}) AS word FROM documents),
    times AS (SELECT doc_id, word, count(*) AS tf FROM words GROUP BY ALL),
    sizes AS (SELECT documents.doc_id, len({_words("text")}) AS size FROM documents),
    facts AS (SELECT count(*) AS n, avg(size) AS mean FROM sizes),
    terms AS (SELECT word, count(*) AS df FROM times GROUP BY word),
    scored AS (
      SELECT q.doc_id AS query_id, t.doc_id,
             sum(CAST(q.tf * ln(1 + (n - df + 0.5) / (df + 0.5)) * t.tf * {topk_search.K1 + 1}
                      / (t.tf + {topk_search.K1} * ({1 - topk_search.B} + {topk_search.B} * size / mean))
                      AS DECIMAL(38, 12))) AS score
      FROM times AS q JOIN terms ON q.word = terms.word JOIN times AS t ON t.word = q.word
           JOIN sizes ON sizes.doc_id = t.doc_id, facts
      WHERE q.doc_id % 50 = 0 GROUP BY q.doc_id, t.doc_id),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 8) DESC, doc_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(CAST(score AS DOUBLE), 6) AS score
    FROM ranked WHERE rank <= {topk_search.TOP}"""


def _rules_sql() -> str:
    """The counts and the table of rules in SQL; windows are counted by grouping them."""
    word, space = "[^\\x20\\x09-\\x0D]+", "[\\x20\\x09-\\x0D]"
    forms = ", ".join(f"'{w}'" for w in sorted({*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)}))
    edges = quality_rules.EDGES.replace("'", "''")
    holds = []
    for rule in quality_rules.RULES:
        per = rule.per or "1"
        if rule.least is not None:
            holds.append(f"{rule.count} >= CAST('{rule.least}' AS DOUBLE) * {per}")
        if rule.most is not None:
            holds.append(f"{rule.count} <= CAST('{rule.most}' AS DOUBLE) * {per}")
    window = quality_rules.WINDOW
    gram = ", ".join(f"words[i + {k}]" for k in range(window))
    return f"""
    WITH held AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
    split AS (
      SELECT *, regexp_extract_all(text, '{word}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
      FROM held),
    windows AS (
      SELECT n, i, [{gram}] AS gram
      FROM (SELECT n, words, unnest(range(1, len(words) - {window - 2})) AS i FROM split WHERE len(words) > {window})),
    repeated AS (SELECT n, gram FROM windows GROUP BY ALL HAVING count(*) > 1),
    covered AS (
      SELECT n, count(DISTINCT i + k) AS n_repeat_words
      FROM windows JOIN repeated USING (n, gram), (SELECT unnest(range(0, {window})) AS k) GROUP BY n),
    counts AS (
      SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
             len(regexp_extract_all(text, '[{quality_rules.SYMBOLS}]')) AS n_symbols, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(list_filter(words, lambda w: trim(w, '{edges}') IN ({forms}))) AS n_stop_words
      FROM split LEFT JOIN covered USING (n)),
    judged AS (
      SELECT *, n_words < {quality_rules.LEAST_WORDS}
                OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words AS base_failed
      FROM counts)
    SELECT *, NOT base_failed AND {" AND ".join(holds)} AS kept FROM judged"""


ORACLES["op12_quality_rules"] = _rules_sql()


def _merkle_sql() -> str:
    """The trees level by level, the proofs by looking up every level's sibling."""
    crc = f"""list_reduce(flatten([[ord(c), 0, 0, 0, 0, 0, 0, 0] for c in string_split(CAST(doc_id AS VARCHAR), '')]),
               lambda a, b: xor(xor(a, b) >> 1, {0xEDB88320} * (xor(a, b) & 1)), {0xFFFFFFFF})"""

    def leaf(chars: str) -> str:
        fields = ("doc_id", "source", "lang", chars, "text")
        parts = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
        return f"sha256({' || '.join(parts)})"

    def levels(name: str, leaves: str) -> str:
        return f"""{name} AS (
      SELECT g, 0 AS level, row_number() OVER (PARTITION BY g ORDER BY k NULLS FIRST, digest) - 1 AS pos, digest,
             count(*) OVER (PARTITION BY g) AS n
      FROM {leaves}
      UNION ALL
      SELECT g, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
      FROM {name} WHERE n > 1 GROUP BY g, level, pos // 2)"""

    def ways(name: str, nodes: str) -> str:
        return f"""{name} AS (
      SELECT f.g, f.pos, list(CASE WHEN s.digest IS NULL THEN '' WHEN s.pos % 2 = 0 THEN 'L' || s.digest
                                   ELSE 'R' || s.digest END ORDER BY l.level) AS steps
      FROM {nodes} AS f JOIN (SELECT DISTINCT g, level FROM {nodes} WHERE n > 1) AS l ON f.g IS NOT DISTINCT FROM l.g
      LEFT JOIN {nodes} AS s ON s.g IS NOT DISTINCT FROM f.g AND s.level = l.level AND s.pos = xor(f.pos >> l.level, 1)
      WHERE f.level = 0 GROUP BY f.g, f.pos)"""

    return f"""
    WITH RECURSIVE leaves AS (
      SELECT lang AS g, doc_id AS k, {leaf("n_chars")} AS digest,
             CASE WHEN xor({crc}, {0xFFFFFFFF}) % {TAMPERED} = 0 THEN {leaf("(n_chars + 1)")} END AS changed
      FROM documents),
    {levels("nodes", "leaves")},
    subroots AS (SELECT 1 AS g, lang_at AS k, digest, lang FROM (
      SELECT g AS lang, digest, row_number() OVER (ORDER BY g NULLS FIRST) AS lang_at FROM nodes WHERE n = 1)),
    {levels("tops", "subroots")},
    {ways("inner_ways", "nodes")},
    {ways("outer_ways", "tops")},
    placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k NULLS FIRST, digest) - 1 AS pos FROM leaves),
    whole AS (
      SELECT placed.k AS doc_id, placed.digest AS leaf, changed, subroots.digest AS subroot,
             (SELECT digest FROM tops WHERE n = 1) AS root,
             list_concat(coalesce(i.steps, []), coalesce(o.steps, [])) AS steps
      FROM placed JOIN subroots ON placed.g IS NOT DISTINCT FROM subroots.lang
           LEFT JOIN inner_ways AS i ON i.g IS NOT DISTINCT FROM placed.g AND i.pos = placed.pos
           LEFT JOIN outer_ways AS o ON o.pos = subroots.k - 1),
    folded AS (
      SELECT *, list_reduce(steps, lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END),
                            coalesce(changed, leaf)) AS folded_root
      FROM whole)
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string([s[2:] for s in steps], '')) AS proof_sha256, folded_root,
           folded_root = root AS verified
    FROM folded"""


ORACLES["op11_merkle_manifest"] = _merkle_sql()
