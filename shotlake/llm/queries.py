"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.llm import divergence, embedding_dedup, fingerprints, hard_negatives, jaccard_join, mixing, packing, quality, secret_scan, sharding, tokens, toxicity, warc
from shotlake.llm.common import SEED, documents
from shotlake.sources.scratch import new_path


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.compare_with_edits(documents(spark, sf_dir))
    own, edited, following = (F.col(f"fingerprints.{c}") for c in ("own", "edited", "following"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.written(own).alias("fingerprint"),
        fingerprints.written(edited).alias("edited_fingerprint"),
        fingerprints.likeness(own, edited).alias("near_edited"),
        fingerprints.likeness(own, following).alias("near_next"),
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = toxicity.score(docs, toxicity.train(docs, labels))
    return rows.select(F.col("record.doc_id").alias("doc_id"), *[f"p_{c}" for c in toxicity.NAMES], "toxic")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.counted(documents(spark, sf_dir))
    return mixing.positions(rows, mixing.weights(rows))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    kinds = [k for k, *_ in secret_scan.BASE]
    return rows.select(
        F.col("record.doc_id").alias("doc_id"),
        *[count(k) for k in kinds],
        F.sha2(secret_scan.written(F.col("spans"), kinds), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffle_shards(documents(spark, sf_dir), shards=sharding.SHARDS)
    text = F.coalesce("record.text", F.lit(""))
    key = F.coalesce(F.col("record.doc_id").cast("string"), F.lit("null"))
    return rows.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        sharding.shard_of(key, sharding.SHARDS + 1).cast("int").alias("grown_shard"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.read(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir)).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_secrets": op9_secrets,
    "op10_sharding": op10_sharding,
    "op11_warc": op11_warc,
    "op12_divergence": op12_divergence,
    "op13_hard_negatives": op13_hard_negatives,
}

#: Shingles joined with themselves, links by the size of the intersection, components by reachability.
_SQL_JACCARD = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * both_have >= 80 * (u.n + v.n - both_have)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(doc_id, least) AS (SELECT DISTINCT x, x FROM e UNION SELECT e.y, reach.least FROM reach JOIN e ON e.x = reach.doc_id WHERE reach.least < e.y),
c AS (SELECT doc_id, min(least) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id"""


def _sql_secrets() -> str:
    """Matches by what lies between them, entropy by counting each window's characters."""
    letters = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    words = "|".join(letters(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    patterns = {"assign": f"""(?:{words})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    found, kinds = [], secret_scan.KINDS
    for kind, _, value, least in secret_scan.BASE:
        found.append(f"SELECT doc_id, {kinds.index(kind)} AS rank, {least} AS least, string_split_regex(t, '{patterns[kind]}') AS gaps, regexp_extract_all(t, '{patterns[kind]}') AS found, regexp_extract_all(t, '{patterns[kind]}', {value}) AS told FROM d")
    for kind, pattern, *_ in secret_scan.CLASSES:
        found.append(f"SELECT doc_id, {kinds.index(kind)}, 0, string_split_regex(t, '{pattern}'), regexp_extract_all(t, '{pattern}'), regexp_extract_all(t, '{pattern}') FROM d")
    n, hexes, others = secret_scan.WINDOW, *[kinds.index(k) for k, *_ in secret_scan.CLASSES]
    bits = {kinds.index(k): b for k, _, _, _, b in secret_scan.CLASSES}
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({' UNION ALL '.join(found)}),
o AS (SELECT doc_id, rank, least, found, told, [length(x) for x in gaps] AS g, [length(x) for x in found] AS f, unnest(range(1, len(found) + 1)) AS i FROM m WHERE len(found) > 0),
p AS (SELECT doc_id, rank, found[i] AS x, CAST(list_sum(g[1:i]) + coalesce(list_sum(f[1:i - 1]), 0) AS BIGINT) AS a, CAST(list_sum(g[1:i]) + list_sum(f[1:i]) AS BIGINT) AS b FROM o WHERE length(told[i]) >= least),
base AS (SELECT doc_id, rank, a, b FROM p WHERE rank < {len(secret_scan.BASE)}),
rest AS (SELECT doc_id, rank, x, a, CASE WHEN regexp_matches(x, '{secret_scan.PLACEHOLDER}') THEN array_to_string([CASE WHEN regexp_matches(y, '{secret_scan.PLACEHOLDER}') THEN repeat('-', length(y)) ELSE y END for y in regexp_extract_all(x, '[^/=]*[/=]|[^/=]+')], '') ELSE x END AS r FROM p WHERE rank >= {len(secret_scan.BASE)}),
tried AS (SELECT doc_id, rank, a, CASE rank WHEN {hexes} THEN lower(r) ELSE r END AS r FROM rest WHERE {' AND '.join(f"NOT regexp_matches(r, '{w}')" for w in secret_scan.ALLOWED[:-1])} AND NOT (rank = {others} AND regexp_matches(x, '^[0-9A-Fa-f]*$'))),
w AS (SELECT doc_id, rank, a, r, unnest(range(0, length(r) - {n - 1})) AS k FROM tried),
c AS (SELECT doc_id, rank, a, k, y, count(*) AS n FROM (SELECT doc_id, rank, a, k, unnest(string_split(substr(r, CAST(k AS INT) + 1, {n}), '')) AS y FROM w) GROUP BY ALL),
h AS (SELECT doc_id, rank, a, k, log2({n}) - sum(n * log2(n)) / {n} AS bits FROM c GROUP BY ALL),
e AS (SELECT doc_id, rank, a + min(k) AS a, a + max(k) + {n} AS b FROM h WHERE bits >= CASE rank WHEN {hexes} THEN {bits[hexes]} ELSE {bits[others]} END GROUP BY doc_id, rank, h.a),
every AS (SELECT doc_id, rank, a, b FROM base UNION ALL SELECT doc_id, rank, a, b FROM e WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = e.doc_id AND x.a <= e.a AND x.b >= e.b)),
s AS (SELECT doc_id, rank, a, concat([{', '.join(f"'{k}'" for k in kinds)}][rank + 1], ':', a, ':', b) AS s FROM every),
g AS (SELECT doc_id, {', '.join(f'count(*) FILTER (WHERE rank = {i}) AS n_{k}' for i, (k, *_) in enumerate(secret_scan.BASE))}, string_agg(s, ',' ORDER BY a, rank) FILTER (WHERE rank < {len(secret_scan.BASE)}) AS base, string_agg(s, ',' ORDER BY a, rank) AS spans FROM s GROUP BY 1)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k, *_ in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""


#: The exponent by sixty halvings, the order of each epoch by the same hashes, places by window sums.
_SQL_MIXING = f"""WITH RECURSIVE r AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.TOKEN}')) AS BIGINT) AS n_tokens FROM documents),
shares AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM r GROUP BY 1 HAVING sum(n_tokens) > 0),
x AS (SELECT CAST(min(tokens) AS DOUBLE) AS least, CAST(max(tokens) AS DOUBLE) AS most, CAST(sum(tokens) AS DOUBLE) AS total FROM shares),
half(i, lo, hi) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) UNION ALL SELECT i + 1, CASE WHEN met THEN lo ELSE mid END, CASE WHEN met THEN mid ELSE hi END FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, pow(most / least, 1 - (lo + hi) / 2) <= {mixing.MAX_REPETITION} AS met FROM half, x) WHERE i < 60),
e AS (SELECT CASE WHEN most / least <= {mixing.MAX_REPETITION} THEN 0 ELSE hi END AS e FROM x, half WHERE i = 60),
b AS (SELECT source, tokens, CAST(round(pow(tokens / total, e) * (total * pow(most / total, 1 - e))) AS BIGINT) AS budget FROM shares, x, e),
p AS (SELECT s.source, s.blocks, budget, CAST(coalesce(budget // tokens, 1) AS INT) AS epochs, coalesce(budget % tokens, 0) AS rest FROM (SELECT source, greatest(1, CAST(ceil(count(*) / {mixing.BLOCK}.0) AS INT)) AS blocks FROM r GROUP BY 1) s LEFT JOIN b ON s.source IS NOT DISTINCT FROM b.source),
u AS (SELECT r.doc_id, r.source, n_tokens, blocks, budget, epochs, rest, CAST(unnest(range(0, epochs + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS INT) AS epoch FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source),
o AS (SELECT *, CAST(concat('0x', substr(md5(concat_ws(':', {SEED}, epoch, coalesce(CAST(doc_id AS VARCHAR), 'null'), n_tokens)), 1, 15)) AS BIGINT) AS o FROM u),
k AS (SELECT *, CAST(floor(CAST(o AS DOUBLE) / 1152921504606846976.0 * blocks) AS INT) AS block FROM o),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY source, epoch, block ORDER BY o, doc_id NULLS FIRST, n_tokens) - 1 AS INT) AS slot, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY block, o, doc_id NULLS FIRST, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS inside FROM k)
SELECT doc_id, source, n_tokens, epoch, block, slot, inside + epoch * coalesce((budget - rest) // greatest(epochs, 1), 0) AS start, CASE WHEN budget IS NULL THEN 0 ELSE inside + epoch * ((budget - rest) // greatest(epochs, 1)) END / CAST(coalesce(budget, 1) AS DOUBLE) AS position FROM t WHERE epoch < epochs OR inside < rest"""

#: Five hexadecimal digits are four of base 32; of equal pages the first is the response.
_SQL_WARC = f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS FIRST) AS n, first_value(page_id) OVER (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS FIRST) AS first FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, array_to_string([substr('{warc.BASE32}', CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INT), 5) AS INT) >> CAST(15 - i % 4 * 5 AS INT)) % 32 AS INT) + 1, 1) for i in range(32)], '') AS payload_digest,
CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN first END AS refers_to FROM r"""

#: Every kept term priced for every group and language, absent or not; every pair of groups joined on all terms.
_SQL_DIVERGENCE = f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
a AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT lang, term, sum(n)::BIGINT AS n FROM a GROUP BY 1, 2),
p AS (SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g))::BIGINT AS p FROM a WINDOW g AS (PARTITION BY lang, source)),
q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g))::BIGINT AS q FROM l WINDOW g AS (PARTITION BY lang)),
s AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
u AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
UNION ALL SELECT p.lang, p.source, 'term', p.term, p - q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM u)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank FROM o WHERE part = 'pair' OR rank <= {divergence.TOP}"""

#: Every product of an anchor and a row, ranked.
_SQL_HARD_NEGATIVES = """WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT) for x in embedding] AS v FROM embeddings
WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, coalesce(list_sum([p[1] * p[2] for p in list_zip(a.v, b.v)]), 0) AS score FROM e a JOIN e b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT a, anchor_id, r AS p, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) <= 5),
n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score, row_number() OVER (PARTITION BY a, p ORDER BY score DESC, vec_id, r) AS rank FROM p JOIN s USING (a, anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score, CAST(negative_score AS BIGINT) AS negative_score FROM n WHERE rank <= 5"""

ORACLE_SQL: dict[str, str] = {"op11_warc": _SQL_WARC, "op12_divergence": _SQL_DIVERGENCE, "op13_hard_negatives": _SQL_HARD_NEGATIVES, "op8_mixing": _SQL_MIXING, "op9_secrets": _sql_secrets(), "op2_jaccard_join": _SQL_JACCARD}
