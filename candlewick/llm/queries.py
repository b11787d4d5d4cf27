"""The registered queries of this subpackage: whole tables in, digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import centroids, contamination, fingerprints, graphs, language, lines, negatives, neardups, substrings, tokens, toxicity, urls, warc
from candlewick.llm.common import Scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_test_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[start:start + 9], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS start FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
  SELECT doc_id, size, start, array_to_string(words[start:start + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start FROM split CROSS JOIN sizes)),
hits AS (SELECT doc_id, start, size, item_id FROM windows JOIN phrases USING (size, phrase)),
hit_words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + size)) AS pos FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back, revisits by headers alone."""
    scratch = Scratch(spark, "warc")
    warc.write(warc.page_records(table(spark, sf_dir, "pages"), scratch), scratch.path("archives"))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).cast("long")
    responses = warc.read(spark, scratch.path("archives")).where("record_type = 'response'")
    revisits = warc.read(spark, scratch.path("archives"), payload=False).where("record_type = 'revisit'")
    return responses.select(
        page(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    ).union(
        revisits.select(page(F.col("record_id")), "payload_length", F.regexp_replace("payload_digest", "^sha256:", ""), "record_type", page(F.col("refers_to")))
    )


OP3_SQL = r"""
WITH paid AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_page FROM paid WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_page < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_page < page_id THEN first_page END AS refers_to
FROM paid LEFT JOIN firsts USING (payload_digest)
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.drop_repeated_windows(table(spark, sf_dir, "documents"), 50)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS start FROM split),
hashed AS (
  SELECT doc_id, start, md5(array_to_string(words[start:start + 49], ' ')) AS phrase FROM windows),
firsts AS (SELECT phrase, min(doc_id) AS first_doc FROM hashed GROUP BY phrase),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS pos
  FROM hashed JOIN firsts USING (phrase) WHERE first_doc < doc_id),
words AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS text
  FROM words ANTI JOIN removed USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


#: The rules of the contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark, RULES))


OP5_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^?#]*') AS whole FROM rest),
named AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(whole, length(raw) + 1) AS path FROM parts),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM named)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardups.near_duplicates(table(spark, sf_dir, "documents"), neardups.Likeness(words=3, percent=85))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP7_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[start:start + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS start FROM split WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS root FROM split
  UNION
  SELECT edges.b AS id, reach.root FROM reach JOIN edges ON edges.a = reach.id WHERE reach.root < edges.b)
SELECT split.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id, min(root) = split.doc_id AS kept
FROM split JOIN reach ON reach.id = split.doc_id LEFT JOIN sizes ON sizes.doc_id = split.doc_id GROUP BY split.doc_id
"""


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs)).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.drop_common_lines(table(spark, sf_dir, "documents"), 10)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
"""


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of every text, and whether decoding gives the text back."""
    encoder = tokens.read_encoder()
    coded = tokens.decode(tokens.encode(table(spark, sf_dir, "documents"), encoder, 3), encoder)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.get("scores", F.lit(0)).alias("best_score"),
        F.get("scores", F.lit(1)).alias("second_score"),
        F.get("scores", F.lit(2)).alias("third_score"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    mislabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", mislabelled), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM known a JOIN known b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id
  WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))


def _op12_sql() -> str:
    """Starts, three rounds of assignment and means, and the last assignment, one after the other."""
    parts = ["""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
centres_0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, q AS c FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16)"""]
    for turn in range(4):
        parts.append(f"""
far_{turn} AS (
  SELECT vec_id, q, cluster, list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
  FROM kept CROSS JOIN centres_{turn}),
near_{turn} AS (
  SELECT * FROM far_{turn} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if turn < 3:
            parts.append(f"""
sums_{turn} AS (
  SELECT cluster, place, sum(x) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(q) AS x, unnest(range(64)) AS place FROM near_{turn}) GROUP BY cluster, place),
means_{turn} AS (
  SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY place) AS mean FROM sums_{turn} GROUP BY cluster),
centres_{turn + 1} AS (
  SELECT cluster, list_transform(coalesce(mean, c), lambda x: CAST(x AS BIGINT)) AS c FROM centres_{turn} LEFT JOIN means_{turn} USING (cluster))""")
    return ",".join(parts) + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near_3 JOIN centres_3 USING (cluster)
"""


OP12_SQL = _op12_sql()


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


REGISTRY: dict[str, tuple[Query, str | None]] = {
    "op1_decontamination": (op1_decontamination, OP1_SQL),
    "op2_fingerprints": (op2_fingerprints, None),
    "op3_warc": (op3_warc, OP3_SQL),
    "op4_substring_dedup": (op4_substring_dedup, OP4_SQL),
    "op5_url_filter": (op5_url_filter, OP5_SQL),
    "op6_toxicity": (op6_toxicity, None),
    "op7_near_duplicates": (op7_near_duplicates, OP7_SQL),
    "op8_language_id": (op8_language_id, None),
    "op9_line_dedup": (op9_line_dedup, OP9_SQL),
    "op10_sentencepiece": (op10_sentencepiece, None),
    "op11_hard_negatives": (op11_hard_negatives, OP11_SQL),
    "op12_centroids": (op12_centroids, OP12_SQL),
    "op13_nearest": (op13_nearest, None),
}
