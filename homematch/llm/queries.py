"""Registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from homematch.llm import (
    alignment, fingerprint, language_id, license_scan, merkle, near_dedup, packing, piece_codec, quality_net, quality_rules, sharding, simhash, url_filter,
)
from homematch.llm.common import id_remainder, table

RUNS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    RUNS[run.__name__] = run
    return run


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(RUNS)


def checks() -> dict[str, str]:
    return dict(CHECKS)


@query
def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document, by shingles of two words."""
    return near_dedup.near_duplicates(table(spark, folder, "documents"), width=2)


@query
def op2_quality_net(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality_net.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return license_scan.scan_licences(table(spark, folder, "documents"))


def template_values() -> str:
    """Template words, labels and mandatory phrases as SQL rows."""
    known = license_scan.templates()
    rows = [f"({t.number}, '{t.label}', {list(t.words)}, {list(t.phrase)}, {t.phrase_at})" for t in known]
    return ", ".join(rows)


def base_values() -> str:
    return ", ".join(f"({phrase.split()}, '{label}')" for phrase, label in license_scan.BASE_PHRASES.items())


CHECKS["op3_license_scan"] = rf"""
WITH templates(template, label, tw, pw, phrase_at) AS (
    VALUES {template_values()}
), base(pw, label) AS (
    VALUES {base_values()}
), d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), licence_words AS (
    SELECT unnest(tw) AS word FROM templates UNION SELECT unnest(pw) FROM base
), hits AS (
    SELECT r, word, pos FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d) SEMI JOIN licence_words USING (word)
), weights AS (
    SELECT word, ln(((SELECT count(*) FROM d) + 1) / (count(DISTINCT r) + 1)) + 1 AS weight
    FROM licence_words LEFT JOIN hits USING (word) GROUP BY word
), places AS (
    SELECT template, label, unnest(tw) AS word, unnest(range(len(tw))) AS place FROM templates
), postings AS (
    SELECT template, label, word, place, weight FROM places JOIN weights USING (word)
), totals AS (
    SELECT template, sum(weight) AS total FROM postings GROUP BY template
), agreed AS (
    SELECT r, template, label, pos - place AS start, sum(weight) AS weight FROM hits JOIN postings USING (word) GROUP BY ALL
), held AS (
    SELECT r, a.label, least(1.0, weight / total) AS share
    FROM agreed a JOIN totals USING (template) JOIN templates t USING (template) JOIN d USING (r)
    WHERE weight >= {license_scan.LEAST_SHARE} * total - 1e-9 AND start + phrase_at >= 0
      AND w[start + phrase_at + 1:start + phrase_at + len(pw)] = pw
), method AS (
    SELECT r, label, max(share) AS share FROM held GROUP BY r, label
), starts AS (
    SELECT r, label, pos FROM hits JOIN d USING (r) JOIN base b ON word = b.pw[1] WHERE w[pos + 1:pos + len(pw)] = pw
), base_found AS (
    SELECT r, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM starts GROUP BY r
), all_labels AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM method UNION SELECT r, label FROM starts) GROUP BY r
), best AS (
    SELECT r, max(share) AS share FROM method GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(f.n, 0) AS n_base, first_word, last_word, coalesce(f.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       round(CASE WHEN f.n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE, 6) AS score
FROM d LEFT JOIN base_found f USING (r) LEFT JOIN all_labels a USING (r) LEFT JOIN best USING (r)
"""


@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    return language_id.identify_languages(table(spark, folder, "documents"))


@query
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard and slot; counts of shards differ by one at most."""
    placed = sharding.shard_rows(table(spark, folder, "documents"), shards=24, seed=20)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge_documents(table(spark, folder, "documents"))


CHECKS["op6_quality_rules"] = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), words AS (
    SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), windows AS (
    SELECT r, i, array_to_string(w[i:i + 4], chr(1)) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
), again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, sum(least(5, coalesce(following - i, 5))) AS n
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM again) GROUP BY r
), lines AS (
    SELECT r, host, doc, l FROM (SELECT r, host, coalesce('id ' || doc_id, 'text ' || t) AS doc, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), line_counts AS (
    SELECT r, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY r
), keyed AS (
    SELECT r, host, doc, trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS k,
           length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS chars
    FROM lines
), common AS (
    SELECT host, k FROM keyed GROUP BY host, k HAVING count(DISTINCT doc) > {quality_rules.LINE_LIMIT}
), gone AS (
    SELECT r, sum(chars) AS n FROM keyed JOIN common USING (host, k) GROUP BY r
), counted AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(line_counts.n, 0) AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS gone_chars
    FROM d JOIN words USING (r) LEFT JOIN line_counts USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)
), failed AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, word_chars - gone_chars AS left_chars FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * left_chars >= {quality_rules.LEAST_LEFT_PERCENT} * word_chars AS kept, left_chars
FROM failed
"""


@query
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    found = fingerprint.fingerprint_documents(table(spark, folder, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page's url; hosts are listed by a rule on their digest, about one in sixteen."""
    pages = table(spark, folder, "pages")
    hosts = pages.select(url_filter.url_parts(F.col("url"))[0].alias("host")).distinct()
    return url_filter.judge_urls(pages, URL_RULES, hosts.where(F.md5(F.col("host").cast("binary")).startswith("0")))


CHECKS["op8_url_filter"] = r"""
WITH parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
    SELECT p.*, r.verdict AS rule_verdict, r.rule_host || r.rule_path AS fitted
    FROM parts p LEFT JOIN rules r
      ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, arg_max(fitted, length(fitted)) AS rule,
       coalesce(arg_max(rule_verdict, length(fitted)), CASE WHEN starts_with(md5(host), '0') THEN 'block' ELSE 'allow' END) AS verdict
FROM fitting GROUP BY page_id, host, path
"""


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    pieces = packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def joined_ids(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


@query
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of all documents, as digests."""
    coded = piece_codec.encode_documents(table(spark, folder, "documents"), public_tokenizers.path(PIECE_BPE))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(joined_ids(F.col("ids")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the check of a copy in which some counts were changed."""
    chars = F.col("n_chars").cast("decimal(38,0)")
    changed = F.when(F.col("doc_id").isNotNull() & (id_remainder("doc_id", 7) == 0), chars + 1).otherwise(chars)
    held = merkle.dataset_manifest(table(spark, folder, "documents"), MANIFEST_FIELDS, {"n_chars": changed})
    shown = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")]
    return held.select("doc_id", *shown, merkle.siblings_digest(F.col("path")).alias("proof_sha256"), "verified")


def sql_climb(name: str, start: str) -> str:
    """Recursive SQL table that climbs two by two from leaves (r, grp, pos, n, node, now, sibs)."""
    return f"""{name}(r, grp, pos, n, node, now, sibs) AS (
    {start}
    UNION ALL
    SELECT r, grp, pos // 2, (n + 1) // 2, sha256(c0 || c1), sha256(CASE WHEN pos % 2 = 0 THEN now || c1 ELSE c0 || now END),
           sibs || CASE WHEN pos % 2 = 0 THEN c1 ELSE c0 END
    FROM (
        SELECT *, max(CASE WHEN pos % 2 = 0 THEN node END) OVER run AS c0, coalesce(max(CASE WHEN pos % 2 = 1 THEN node END) OVER run, '') AS c1
        FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY grp, pos // 2)
    )
)"""


def sql_field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def sql_leaf(chars: str) -> str:
    return "sha256(" + " || ".join(map(sql_field, ["doc_id", "source", "lang", chars, "text"])) + ")"


CHECKS["op11_merkle_manifest"] = f"""
WITH RECURSIVE bits(i, v, k) AS (
    SELECT i, i::UBIGINT, 0 FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc(i, v) AS (
    SELECT i, v FROM bits WHERE k = 8
), sums(id, place, v) AS (
    SELECT id, 0, 4294967295::UBIGINT FROM (SELECT DISTINCT doc_id::VARCHAR AS id FROM documents WHERE doc_id IS NOT NULL)
    UNION ALL
    SELECT id, place + 1, xor(crc.v, s.v >> 8) FROM sums s JOIN crc ON crc.i = xor(s.v & 255, ascii(id[place + 1])::UBIGINT) WHERE place < length(id)
), changed AS (
    SELECT id FROM sums WHERE place = length(id) AND xor(v, 4294967295::UBIGINT) % 7 = 0
), d AS (
    SELECT row_number() OVER () AS r, *, coalesce('1' || lang, '0') AS grp, doc_id::VARCHAR IN (FROM changed) AND doc_id IS NOT NULL AS tampered FROM documents
), hashed AS (
    SELECT *, {sql_leaf("n_chars")} AS leaf, {sql_leaf("n_chars::HUGEINT + CASE WHEN tampered THEN 1 ELSE 0 END")} AS now FROM d
), {sql_climb("tree", """SELECT r, grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1, count(*) OVER (PARTITION BY grp), leaf, now, '' FROM hashed""")
}, subs AS (
    SELECT * FROM tree WHERE n = 1
), {sql_climb("top", """SELECT r, '', dense_rank() OVER (ORDER BY grp) - 1, (SELECT count(DISTINCT grp) FROM subs), node, now, sibs FROM subs""")}
SELECT doc_id, leaf, subs.node AS subroot, top.node AS root, top.now AS folded_root, sha256(top.sibs) AS proof_sha256, top.now = top.node AS verified
FROM hashed JOIN subs USING (r) JOIN top USING (r) WHERE top.n = 1
"""


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    known = alignment.load_vocabularies(public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))
    aligned = alignment.align_documents(table(spark, folder, "documents"), known)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    counted = alignment.with_counts(alignment.stored(aligned.select("doc_id", "n_a", "n_b", "n_groups", digest, "links")), known)
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.simhash_duplicates(table(spark, folder, "documents"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, folder)
