"""One query per operator over the driver's tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    fingerprints,
    impact_search,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    phrase_mining,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    url_filters,
    warc,
)
from .common import LOWER, UPPER, WHITE_RUN, cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and MCD verdict of every document."""
    rated = quality_rules.rate(table(spark, sf_dir, "documents"))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "distance")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive-unlabelled quality score of every document."""
    return quality_classifier.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return ngram_join.components(table(spark, sf_dir, "documents"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned slot of every piece of every document."""
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and log-frequency Bloom filter score of every document."""
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.train(docs))


@query
def op2_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invertible Bloom lookup fingerprints of every document and its edited text."""
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def _tokens_sql() -> str:
    words = f"regexp_extract_all(coalesce(text, ''), '{WHITE_RUN.replace('[', '[^', 1)}')"
    return f"""
WITH kept AS (
  SELECT source, lang, len({words}) AS words,
         len(list_filter({words}, lambda w: regexp_matches(w, '{token_counts.SOLID}'))) AS solid,
         len(regexp_extract_all(coalesce(text, ''), '{token_counts.RUNS}')) AS runs
  FROM documents
  WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)
)
SELECT source, lang, 'words-1' AS version, count(*) AS n_docs, CAST(sum(solid) AS BIGINT) AS n_tokens
FROM kept GROUP BY ALL
UNION ALL
SELECT source, lang, 'runs-1', count(*), CAST(sum(runs) AS BIGINT) FROM kept GROUP BY ALL"""


ORACLES["op1_token_rollups"] = _tokens_sql()


@query
def op1_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer version after a load, deletions and a revision."""
    store = token_counts.create(spark, scratch_path(spark, "token-store"))
    counts = token_counts.document_counts(table(spark, sf_dir, "documents"))
    return token_counts.corpus_history(counts, table(spark, sf_dir, "labels"), store)


ORACLES["op3_url_cascade"] = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), keys AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
)
SELECT page_id, host, path,
       (SELECT max_by(h || p, length(h || p)) FROM rules
        WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce((SELECT max_by(verdict, length(h || p)) FROM rules
                 WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM keys"""


@query
def op3_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL by a Bloom filter cascade."""
    return url_filters.judge(table(spark, sf_dir, "pages"))


def _warc_sql() -> str:
    def r(x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, '{pattern}', {to}, 'g')"

    text = r(r("payload", warc.SILENT_RUN, "' '"), warc.COMMENT, "' '")
    text = r(r(r(text, r"\n", "' '"), warc.BLOCK_TAG, "chr(10)"), warc.TAG, "''")
    for name, char in warc.ENTITIES:
        text = f"replace({text}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    text = f"trim({r(r(text, warc.BLANKS, chr(39) + ' ' + chr(39)), warc.BREAKS, 'chr(10)')}, ' ' || chr(10))"

    def urn(seed: str) -> str:
        h = f"sha256({seed})"
        return "'urn:uuid:' || concat_ws('-', " + ", ".join(
            f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")"

    return f"""
WITH source AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages
), responses AS (
  SELECT *, {urn("concat_ws(chr(10), coalesce(CAST(page_id AS VARCHAR), '-'), target_uri, sha256(payload))")} AS refers_to,
         'sha256:' || sha256(payload) AS source_digest FROM source
), made AS (
  SELECT page_id, refers_to, target_uri, source_digest, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
         concat_ws(chr(13) || chr(10), 'source-header: HTTP/1.1 200 OK',
                   'source-header: Content-Type: text/html; charset=utf-8',
                   'source-header: Content-Length: ' || octet_length(encode(payload)),
                   'source-payload-digest: ' || source_digest,
                   'title: ' || regexp_replace(regexp_extract(payload, '{warc.TITLE}', 1), '[\\x20\\x09-\\x0D]+', ' ', 'g'),
                   'language: ' || regexp_extract(payload, '{warc.LANGUAGE}', 1),
                   array_to_string(list_transform(regexp_extract_all(payload, '{warc.LINK}', 1),
                                                  lambda x: 'outlink: ' || x), chr(13) || chr(10)))
         || chr(13) || chr(10) AS content
  FROM responses
  UNION ALL
  SELECT page_id, refers_to, target_uri, source_digest, 'conversion', 'text/plain; charset=utf-8', {text} FROM responses
)
SELECT page_id, warc_type, {urn("concat_ws(chr(10), warc_type, refers_to)")} AS record_id, refers_to, target_uri,
       source_digest, 'sha256:' || sha256(content) AS block_digest, content_type,
       octet_length(encode(content)) AS content_length, content FROM made"""


ORACLES["op4_warc_derivatives"] = _warc_sql()


@query
def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    records = warc.responses(table(spark, sf_dir, "pages"))
    return warc.derivatives(records, ["page_id"]).drop("date")


ORACLES["op11_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM d WHERE len(w) >= 20
), again AS (
  SELECT doc_id, pos FROM places
  QUALIFY row_number() OVER (PARTITION BY array_to_string(w[pos:pos + 19], ' ') ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT DISTINCT doc_id, pos + j AS pos FROM again, range(20) AS t(j)
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d
), kept AS (
  SELECT doc_id, count(gone.pos) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone.pos IS NULL) AS text
  FROM words LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words without windows of 20 that start earlier too."""
    kept = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    kept = kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
    return cut(kept, "kept-digests", substring_dedup.SOME)


ORACLES["op12_phrase_mining"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), runs AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), spans AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM runs, range(1, 6) AS t(k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM spans GROUP BY lang, k, phrase
  HAVING count(*) >= 100
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM runs GROUP BY lang
), inside AS (
  SELECT DISTINCT long.lang, array_to_string(long.w[i:i + size - 1], ' ') AS phrase, long.f
  FROM f AS long, range(2, 5) AS s(size), range(1, 5) AS t(i) WHERE size < long.k AND i + size - 1 <= long.k
), cuts AS (
  SELECT f.lang, f.phrase, f.f AS a, l.f AS l, r.f AS r, n, j,
         CAST(1000::HUGEINT * f.f * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM f, range(1, 5) AS t(j), f AS l, f AS r, totals
  WHERE j < f.k AND l.lang = f.lang AND r.lang = f.lang AND totals.lang = f.lang
    AND l.phrase = array_to_string(f.w[1:j], ' ') AND r.phrase = array_to_string(f.w[j + 1:], ' ')
    AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = f.lang AND i.phrase = f.phrase AND 100 * i.f >= 100 * f.f)
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, CAST(row_number() OVER best AS INTEGER) AS rank, phrase, a, l, r, n, score FROM worst
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000"""


@query
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best collocations."""
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_impact_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), lengths AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS (
  SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM lengths
), asked AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, nd
), scores AS (
  SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt)))) AS BIGINT) AS score
  FROM tfs JOIN weights USING (term) JOIN asked USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER best <= 10"""


@query
def op13_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return impact_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
