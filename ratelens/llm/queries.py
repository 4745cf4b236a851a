"""The operators over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm.bpe import bpe_encode
from ratelens.llm.common import table
from ratelens.llm.decontamination import leaks
from ratelens.llm.divergence import source_divergence
from ratelens.llm.licenses import LICENSES, SPELLINGS, find_licenses
from ratelens.llm.line_dedup import Lines, repeated_lines
from ratelens.llm.neighbours import nearest_neighbours
from ratelens.llm.prefix_trie import prefix_trie
from ratelens.llm.quality import clean_lines
from ratelens.llm.secret_scan import BASE_RULES, scan_history
from ratelens.llm.simhash import simhash_components
from ratelens.llm.substring_dedup import repeated_spans
from ratelens.llm.toxicity import score_toxicity
from ratelens.llm.url_filter import Rule, judge_urls

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

URL_RULES = [
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
]


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, of every other document: the second one scans only contents that the first one's ledger lacks."""
    history = table(spark, sf_dir, "documents")
    odd = F.coalesce(F.col("doc_id") % 2 != 0, F.lit(True))
    findings, ledger = scan_history(history.filter(~odd), rule_version="1")
    later, _ = scan_history(history.filter(odd), rule_version="1", ledger=ledger)
    findings = findings.unionByName(later)
    base_kinds = [rule.kind for rule in BASE_RULES]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("findings", lambda s: s["kind"].isin(base_kinds))
    kinds = F.transform("findings", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in base_kinds
    ]
    return findings.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("findings").alias("spans"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    places = F.array_join(F.transform("sentences", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return scored.withColumn("sentences", places)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"))
    places = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", F.size("spans").alias("n_spans"), places.alias("spans"), "copied_from")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents"), with_text=False)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_lines(table(spark, sf_dir, "documents"), Lines(short=True))
    return found.withColumns({"n_repeated": F.size("repeated"), "repeated": F.array_join("repeated", ",")})


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(VOCABULARY)
    return bpe_encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def queries():
    return {
        "op1_secret_scan": secret_scan,
        "op2_url_filter": url_filter,
        "op3_toxicity": toxicity,
        "op4_decontamination": decontamination,
        "op5_substring_dedup": substring_dedup,
        "op6_quality_rules": quality_rules,
        "op7_line_dedup": line_dedup,
        "op8_byte_bpe": byte_bpe,
        "op9_license_scan": license_scan,
        "op10_simhash": simhash_near_dedup,
        "op11_source_divergence": divergence_audit,
        "op12_nearest_neighbours": neighbours,
        "op13_prefix_trie": conversation_trie,
    }


def _license_sql() -> str:
    quoted = [(text.replace("'", "''"), name) for name, text in LICENSES]
    known = ", ".join(f"('{text}', '{name}')" for text, name in quoted)
    keys = ", ".join(f"'{word}'" for word in SPELLINGS)
    values = ", ".join(f"'{word}'" for word in SPELLINGS.values())
    return f"""
WITH known_texts(text, license) AS (VALUES {known}),
spelling AS (SELECT map([{keys}], [{values}]) AS m),
known_words AS (
    SELECT license, list_transform(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'), lambda w: coalesce(m[w], w)) AS w
    FROM known_texts, spelling
),
known AS (SELECT DISTINCT md5(array_to_string(w, ' ')) AS digest, license, w[1] AS first_word, len(w) AS size FROM known_words),
sizes AS (SELECT DISTINCT first_word, size FROM known),
lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
),
every AS (
    SELECT doc_id, place, list_transform(regexp_extract_all(lower(line), '[\\p{{L}}\\p{{N}}]+'), lambda w: coalesce(m[w], w)) AS w
    FROM lines, spelling
    WHERE NOT regexp_matches(line, '^\\s*(?i:copyright\\b|\\(c\\)|©)')
        OR regexp_matches(line, '^\\s*(?i:copyright\\s+(notice|holders?|owners?)\\b)')
),
words AS (
    SELECT *, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY place) AS upto FROM every WHERE len(w) > 0
),
ends AS (
    SELECT a.doc_id, a.place, b.place AS last_place
    FROM words a JOIN sizes s ON s.first_word = a.w[1]
    JOIN words b ON b.doc_id = a.doc_id AND b.upto = a.upto - len(a.w) + s.size AND b.place > a.place
),
runs AS (
    SELECT e.doc_id, e.place, md5(string_agg(array_to_string(l.w, ' '), ' ' ORDER BY l.place)) AS digest
    FROM ends e JOIN words l ON l.doc_id = e.doc_id AND l.place BETWEEN e.place AND e.last_place
    GROUP BY e.doc_id, e.place, e.last_place
),
units AS (
    SELECT doc_id, 'line' AS kind, place, md5(array_to_string(w, ' ')) AS digest FROM words
    UNION ALL SELECT doc_id, 'run', place, digest FROM runs
    UNION ALL SELECT doc_id, 'whole', 0, md5(string_agg(array_to_string(w, ' '), ' ' ORDER BY place)) FROM words GROUP BY doc_id
)
SELECT doc_id,
    string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE kind = 'whole') AS whole_license,
    count(DISTINCT place) FILTER (WHERE kind = 'line') AS license_lines,
    count(DISTINCT place) FILTER (WHERE kind = 'run') AS license_runs,
    string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
FROM units JOIN known USING (digest) GROUP BY doc_id
"""


DIVERGENCE_SQL = """
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
    SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM docs
),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
of_lang AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
of_group AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
scored AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(o.n, 0) + 5 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v) AS q
    FROM grp g JOIN kept k USING (lang) JOIN of_lang l USING (lang)
    LEFT JOIN of_group o ON o.lang = g.lang AND o.source = g.source
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM scored a JOIN scored b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
parts AS (
    SELECT * FROM pairs UNION ALL
    SELECT lang, source, 'term', term, p - q FROM scored WHERE n > 0 AND p > q
),
ranked AS (
    SELECT lang, source, part, item, value::BIGINT AS value,
        row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

TRIE_SQL = """
WITH crc AS (
    SELECT conv_id, xor(list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda crc, byte: list_reduce(range(8), lambda a, i: xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)),
        4294967295), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
),
own AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
        ORDER BY turn NULLS FIRST, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS turns
    FROM conversations GROUP BY conv_id
),
rebuilt AS (
    SELECT o.conv_id, list_concat(list_slice(b.turns, 1, h), list_slice(o.turns, h + 1, len(o.turns))) AS turns
    FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
),
members AS (
    SELECT conv_id, d, list_slice(turns, 1, d) AS path, len(turns) = d AS ends
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * coalesce(strlen(path[d].t), 0) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM members GROUP BY d, path
),
children AS (
    SELECT p.d, p.path, count(*) AS n_children FROM nodes p JOIN nodes c ON c.d = p.d + 1 AND list_slice(c.path, 1, p.d) = p.path GROUP BY ALL
),
subtrees AS (
    SELECT a.d, a.path, count(*) FILTER (WHERE k.path IS NULL) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
    FROM nodes a JOIN nodes b ON b.d >= a.d AND list_slice(b.path, 1, a.d) = a.path
    LEFT JOIN children k ON k.d = b.d AND k.path = b.path GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
    s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.d = n.d AND s.path = n.path
LEFT JOIN children k ON k.d = n.d AND k.path = n.path
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = list_slice(n.path, 1, n.d - 1)
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_license_scan": _license_sql(), "op11_source_divergence": DIVERGENCE_SQL, "op13_prefix_trie": TRIE_SQL}
