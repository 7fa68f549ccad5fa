"""The operators bound to the driver's tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.llm import merge_replay
from beatline.llm.exact_dedup import exact_dedup
from beatline.llm.line_dedup import line_dedup
from beatline.llm.merkle import merkle_manifest
from beatline.llm.mixing import mix
from beatline.llm.quality import quality
from beatline.llm.ranked_search import ranked_search
from beatline.llm.sentencepiece import decode, encode
from beatline.llm.simhash import near_duplicates
from beatline.llm.substring_dedup import substring_dedup
from beatline.llm.token_counts import token_counts
from beatline.llm.token_files import token_files
from beatline.llm.warc import through_archives

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_documents(spark, sf_dir), weights=(3.0, 1.0, 2.0), share=1.5, most=2.0)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(
        _documents(spark, sf_dir),
        public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    return judged.withColumnRenamed("id", "doc_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = through_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), min_revisit_bytes=0)
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(_documents(spark, sf_dir), keep="largest")
    return found.withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return counted.withColumnRenamed("id", "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup(_documents(spark, sf_dir), min_docs=10, min_chars=1)
    return cut.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read.withColumnRenamed("id", "doc_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup(_documents(spark, sf_dir), window=20)
    return cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    both = decode(encode(_documents(spark, sf_dir), path), path)
    return both.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        "ids",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_documents(spark, sf_dir), shingle=4, most=4)
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op11_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = merge_replay.encode(_documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return merge_replay.decode(encoded, path).select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=10)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle_manifest(
        _documents(spark, sf_dir),
        tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
        changes={"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")},
    )
    return proved.withColumnRenamed("id", "doc_id")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
totals AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2 * source_size AS cap,
    1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0) AS free,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS load
  FROM totals
  WINDOW before AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min(free, cap / weight) AS free, arg_min(load, cap / weight) AS load
  FROM filled WHERE free / load <= cap / weight),
targets AS (
  SELECT t.source, source_size, least(t.cap, l.free * t.weight / l.load) AS target
  FROM filled t, level l),
parts AS (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM targets),
tied AS (
  SELECT s.*, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS cum,
    sum(s.size) OVER (PARTITION BY s.source, s.h) AS own
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),
cut AS (
  SELECT source, max(CASE WHEN cum <= rest OR (cum - own < rest AND cum - rest < rest - (cum - own)) THEN h END) AS upto
  FROM tied WHERE rest > 0 AND size > 0 GROUP BY source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (copies + CASE WHEN h <= upto THEN 1 ELSE 0 END))::BIGINT AS taken
FROM tied t LEFT JOIN cut c ON t.source IS NOT DISTINCT FROM c.source
"""

OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP6_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY doc_id
"""

OP3_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM hashed)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    ('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::INT >> (5 * (3 - i % 4))::INT) & 31)::INT, 1)), 'string_agg', '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

OP8_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split),
windows AS (
  SELECT doc_id, pos, word,
    CASE WHEN count(*) OVER ahead = 20 THEN string_agg(word, ' ') OVER ahead END AS own
  FROM placed
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
judged AS (
  SELECT doc_id, pos, word,
    own IS NOT NULL AND row_number() OVER (PARTITION BY own ORDER BY doc_id, pos) > 1 AS again
  FROM windows),
covered AS (
  SELECT doc_id, pos, word, bool_or(again) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM judged)
SELECT d.doc_id, count(word) AS n_words, count(word) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN covered c ON d.doc_id = c.doc_id GROUP BY d.doc_id
"""


OP12_SQL = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sizes AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS every FROM split),
counts AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM split) GROUP BY ALL),
asked AS (
  SELECT item_id, item, term, count(*) AS times FROM (
    SELECT item_id, row_number() OVER () AS item,
      unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, sizes GROUP BY term),
scores AS (
  SELECT item_id, item, doc_id, row,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(terms) * docs) // every))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN split USING (row), sizes
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP13_SQL = """
WITH RECURSIVE fielded AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    (4294967295 - list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 5 = 0 AS tampered
  FROM documents),
leaves AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS claim
  FROM fielded),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes AS (
  SELECT tree, 0 AS depth, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, depth + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, depth, pos // 16, n),
subs AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS depth, pos, subroot AS h, (SELECT count(*) FROM subs) AS n FROM subs
  UNION ALL
  SELECT depth + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16
  FROM tops WHERE n > 1 GROUP BY depth, pos // 16, n),
root AS (SELECT h AS root FROM tops WHERE n = 1),
steps AS (
  SELECT 0 AS part, tree, depth, pos, n FROM nodes WHERE n > 1
  UNION ALL SELECT 1, '', depth, pos, n FROM tops WHERE n > 1),
siblings AS (
  SELECT s.part, s.tree, s.depth, s.pos, coalesce(string_agg(o.h, '' ORDER BY o.pos) FILTER (o.pos < s.pos), '') AS l,
    coalesce(string_agg(o.h, '' ORDER BY o.pos) FILTER (o.pos > s.pos), '') AS r
  FROM steps s JOIN (SELECT 0 AS part, tree, depth, pos, h FROM nodes UNION ALL SELECT 1, '', depth, pos, h FROM tops) o
    ON s.part = o.part AND s.tree = o.tree AND s.depth = o.depth AND s.pos // 16 = o.pos // 16
  GROUP BY ALL),
climb AS (
  SELECT doc_id, leaf, p.tree, subroot, 0 AS part, 0 AS depth, p.pos, coalesce(claim, leaf) AS h, '' AS proof, s.pos AS up,
    row_number() OVER () AS row
  FROM placed p JOIN subs s USING (tree)
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.subroot, CASE WHEN s.pos IS NULL THEN c.part + 1 ELSE c.part END,
    CASE WHEN s.pos IS NULL THEN 0 ELSE c.depth + 1 END, CASE WHEN s.pos IS NULL THEN c.up ELSE c.pos // 16 END,
    CASE WHEN s.pos IS NULL THEN c.h ELSE sha256(s.l || c.h || s.r) END,
    CASE WHEN s.pos IS NULL THEN c.proof ELSE c.proof || s.l || s.r END, c.up, c.row
  FROM climb c LEFT JOIN siblings s
    ON s.part = c.part AND s.tree = CASE WHEN c.part = 0 THEN c.tree ELSE '' END AND s.depth = c.depth AND s.pos = c.pos
  WHERE c.part < 2)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM climb, root WHERE part = 2
"""


def queries() -> dict[str, Query]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and name[2].isdigit()}


def sql() -> dict[str, str]:
    return {
        "op1_mixing": OP1_SQL,
        "op3_warc": OP3_SQL,
        "op4_exact_dedup": OP4_SQL,
        "op6_line_dedup": OP6_SQL,
        "op8_substring_dedup": OP8_SQL,
        "op12_ranked_search": OP12_SQL,
        "op13_merkle": OP13_SQL,
    }
