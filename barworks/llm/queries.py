"""The registered queries opN_<name>: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontamination, exact_dedup, html_text, importance, jaccard_join, license_scan
from . import lm_scoring, pieces, quality_classifier, sharding, suffix_dedup, token_counts
from ._util import documents

#: The folder with the public vocabularies is found by this package (a parameter of the operators).
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.graded(documents(spark, sf_dir), labels).drop("text")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary(WORD_BPE))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(documents(spark, sf_dir))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(documents(spark, sf_dir))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each leak: document, item, and how much of a passage of it was found."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.leaks(documents(spark, sf_dir), benchmark)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", "leak.cosine", "leak.share")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(documents(spark, sf_dir), vocabulary(PIECES)).drop("text")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_removed(documents(spark, sf_dir))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resampled(documents(spark, sf_dir), benchmark)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts differ by one at most: the shards' capacities add up to the number of rows."""
    return sharding.sharded(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return collocations.collocations(docs)


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_token_counts, op3_exact_dedup, op4_html_extraction,
                                 op5_lm_scoring, op6_ngram_jaccard_join,
                                 op7_benchmark_decontamination, op8_license_scans, op9_sentencepiece,
                                 op10_suffix_array_dedup, op11_importance_resampling,
                                 op12_sharding, op13_phrase_collocations)}


def _license_sql() -> str:
    """The license scan as SQL: every line against every template, phrases by the words that follow."""
    up, low = license_scan._UP, license_scan._LOW
    norm = f"trim(regexp_replace(translate(%s, '{up}', '{low}'), '{license_scan._GAP}', ' ', 'g'))"
    phrases = []
    for phrase, label in license_scan.BASE.items():
        words = phrase.split()
        test = " AND ".join([f"word = '{words[0]}'"] + [f"w{i} = '{w}'" for i, w in enumerate(words) if i])
        phrases.append(f"SELECT rid, pos, '{label}' AS label FROM ahead WHERE {test}")
    sets = [(label, license_scan._token_set(t)) for t, label in license_scan.TEMPLATES.items()]
    tokens = ", ".join(f"({k}, '{label}', {len(ts)}, '{w}')" for k, (label, ts) in enumerate(sets) for w in ts)
    return f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT rid, doc_id, text, {norm % 'text'} AS norm FROM base),
w AS (SELECT rid, unnest(string_split(norm, ' ')) AS word, generate_subscripts(string_split(norm, ' '), 1) - 1 AS pos
      FROM t WHERE norm <> ''),
ahead AS (SELECT rid, pos, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2, lead(word, 3) OVER o AS w3
          FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
places AS ({' UNION ALL '.join(phrases)}),
found AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word FROM places GROUP BY rid),
template(tid, label, n, token) AS (VALUES {tokens}),
lines AS (SELECT rid, lid, unnest(string_split({norm % 'line'}, ' ')) AS word FROM (
          SELECT rid, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS lid FROM t)),
hits AS (SELECT rid, lid, tid, any_value(label) AS label, count(DISTINCT word) / any_value(n) AS part
         FROM lines JOIN template ON word = token GROUP BY rid, lid, tid
         HAVING count(DISTINCT word) >= ceil({license_scan.THRESHOLD} * any_value(n) - 1e-9)),
best AS (SELECT rid, max(part) AS part, count(*) AS n_matches FROM hits GROUP BY rid),
base_names AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS names FROM places GROUP BY rid),
all_names AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS names
              FROM (SELECT rid, label FROM places UNION ALL SELECT rid, label FROM hits) GROUP BY rid)
SELECT doc_id, CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS n_words,
       coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(b.names, '') AS base_labels,
       coalesce(a.names, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score,
       coalesce(n_matches, 0)::INTEGER AS n_matches
FROM t LEFT JOIN found USING (rid) LEFT JOIN best USING (rid) LEFT JOIN base_names b USING (rid)
     LEFT JOIN all_names a USING (rid)"""


#: Collocations: all n-grams as text; HUGEINT holds the products.
_PHRASES = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces),
sizes AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
grams AS (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase FROM (
          SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM w CROSS JOIN (SELECT unnest(range(1, 6)) AS size))),
f AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(words[1:k], ' ') AS lpart,
                array_to_string(words[k + 1:], ' ') AS rpart
         FROM (SELECT lang, phrase, f, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k
               FROM f WHERE size > 1)),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, s.n,
                  ((1000::HUGEINT * c.a * s.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lpart
                       JOIN f r ON r.lang = c.lang AND r.phrase = c.rpart JOIN sizes s ON s.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, unnest([array_to_string(words[1:size - 1], ' '), array_to_string(words[2:], ' ')]) AS phrase, f
           FROM (SELECT lang, size, f, string_split(phrase, ' ') AS words FROM f WHERE size > 2)),
within AS (SELECT lang, phrase, max(f) AS f FROM inner_ GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank,
       b.phrase, b.a, b.l, b.r, b.n, b.score
FROM best b LEFT JOIN within w USING (lang, phrase) WHERE w.f IS NULL OR w.f < b.a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) <= 2000"""

ORACLES = {
    "op3_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)""",
    "op8_license_scans": _license_sql(),
    "op13_phrase_collocations": _PHRASES,
}
