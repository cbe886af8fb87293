"""The operators as queries over their whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, factorisation, infilling, lexical, lines, mixing, quality, sharding, simhash, spherical, substrings, urls, wordpiece

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k.json"

URL_RULES = (
    urls.Rule(urls.ALLOW, "com"),
    urls.Rule(urls.BLOCK, "example.com", "/en/"),
    urls.Rule(urls.ALLOW, "www.example.com", "/en/"),
    urls.Rule(urls.BLOCK, "net", "/es/"),
    urls.Rule(urls.BLOCK, "net", "/fr/"),
)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules of every document: word counts, repeats and compression bands."""
    return quality.measure(table(spark, sf_dir, "documents"), rules=quality.Rules())


@query
def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources, long ones preferred by the root of their size."""
    return mixing.mix(table(spark, sf_dir, "documents"), preference=mixing.root).select("doc_id", "size", "source_size", "target", "taken")


# the same in SQL: one row per source with its level, then a running total over each source
ORACLES["op2_pareto_mix"] = """
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS k
    FROM documents),
per_source AS (
    SELECT source, sum(size)::BIGINT AS source_size, (2 * sum(size))::BIGINT AS cap,
        [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM sizes GROUP BY source),
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
            - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level,
        row_number() OVER o AS place
    FROM per_source WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST)),
fixed AS (SELECT min(place) AS first_place, min_by(level, place) AS fit_level FROM levels WHERE level * w <= cap),
targets AS (
    SELECT source, source_size, CASE WHEN place >= first_place THEN fit_level * w ELSE cap::DOUBLE END AS target
    FROM levels CROSS JOIN fixed),
measured AS (
    SELECT source, floor(sqrt(size::DOUBLE))::BIGINT AS m, sum(size)::BIGINT AS words FROM sizes WHERE size > 0 GROUP BY ALL),
shared AS (
    SELECT t.source, m, (target - 2 * coalesce(sum(words) OVER (g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(words * m) OVER (g ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS rate
    FROM measured x JOIN targets t ON x.source IS NOT DISTINCT FROM t.source WINDOW g AS (PARTITION BY t.source ORDER BY m DESC)),
rates AS (SELECT source, max_by(rate, m) AS rate FROM shared WHERE rate * m < 2 GROUP BY source),
wanted AS (
    SELECT s.*, t.source_size, t.target,
        CASE WHEN size = 0 THEN 0::DOUBLE ELSE least(coalesce(r.rate * floor(sqrt(size::DOUBLE)), 2::DOUBLE), 2::DOUBLE) END AS want,
        (('0x' || substr(k, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496::DOUBLE AS u
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
rated AS (
    SELECT *, floor(want) AS sure, CASE WHEN floor(want) < 2 THEN size ELSE 0 END AS free,
        CASE WHEN want > floor(want) THEN (u / (1 - u)) / ((want - floor(want)) / (1 - (want - floor(want)))) ELSE 'inf'::DOUBLE END AS q
    FROM wanted),
ordered AS (
    SELECT *, coalesce(sum(free) OVER (PARTITION BY source ORDER BY q, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(sure * size) OVER (PARTITION BY source) AS certain
    FROM rated)
SELECT doc_id, size, source_size, target,
    (size * (sure + CASE WHEN free > 0 AND 2 * before + free <= 2 * (target - certain) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""


@query
def op3_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of a label among all embeddings, cosine 0.98 or more."""
    return spherical.near_groups(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to token ids and back, as digests."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, keep=["doc_id"]).select("doc_id", *bpe.digests())


@query
def op5_count_min_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 50 words that a document of smaller id has."""
    return substrings.deduplicated(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLES["op5_count_min_windows"] = """
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM docs WHERE len(words) >= 50),
windows AS (SELECT doc_id, s, md5(array_to_string(words[s : s + 49], ' ')) AS w FROM starts),
later AS (SELECT doc_id, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY w) AS least FROM windows) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS at_word FROM later),
marked AS (
    SELECT d.doc_id, d.n, d.word, d.len, g.at_word IS NULL AS stays
    FROM (SELECT doc_id, len(words) AS len, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS n FROM docs) d
    LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.at_word = d.n),
kept AS (
    SELECT doc_id, count(*) FILTER (WHERE NOT stays) AS n_removed, string_agg(word, ' ' ORDER BY n) FILTER (WHERE stays) AS rest
    FROM marked GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(k.rest, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), keep=["doc_id"])


@query
def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes, neighbours by metadata together."""
    placed = sharding.kd_shards(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by SimHash, two bits apart at most."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return groups.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


@query
def op9_suffix_array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later copies of runs of three lines or fifty words, and of whole texts."""
    kept = lines.deduplicated(table(spark, sf_dir, "documents"), min_lines=3, min_words=50, counts=("n_lines", "n_removed"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLES["op9_suffix_array_lines"] = """
WITH cut AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS p
    FROM documents WHERE text IS NOT NULL),
worded AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS n, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM cut WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
ahead AS (
    SELECT *, lead(line, 1) OVER o AS line2, lead(line, 2) OVER o AS line3, words + lead(words, 1) OVER o AS words2
    FROM worded WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
runs AS (
    SELECT doc_id, n, 1 AS depth, line AS run FROM ahead WHERE words >= 50
    UNION ALL SELECT doc_id, n, 2, line || chr(10) || line2 FROM ahead WHERE words2 >= 50
    UNION ALL SELECT doc_id, n, 3, line || chr(10) || line2 || chr(10) || line3 FROM ahead WHERE line3 IS NOT NULL),
later AS (
    SELECT doc_id, n, depth FROM (
        SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, n) AS copy FROM runs) WHERE copy > 1),
wholes AS (
    SELECT doc_id, count(*) AS lines, row_number() OVER (PARTITION BY string_agg(line, chr(10) ORDER BY n) ORDER BY doc_id) AS copy
    FROM worded GROUP BY doc_id),
gone AS (
    SELECT doc_id, unnest(range(n, n + depth)) AS n FROM later
    UNION SELECT doc_id, unnest(range(1, lines + 1)) FROM wholes WHERE copy > 1),
marked AS (
    SELECT c.doc_id, c.p, c.line, w.n IS NOT NULL AS worded, g.n IS NOT NULL AS lost
    FROM cut c LEFT JOIN worded w ON w.doc_id = c.doc_id AND w.p = c.p LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.n = w.n)
SELECT d.doc_id, coalesce(count(*) FILTER (WHERE worded), 0)::BIGINT AS n_lines,
    coalesce(count(*) FILTER (WHERE lost), 0)::BIGINT AS n_removed,
    sha256(coalesce(string_agg(m.line, chr(10) ORDER BY m.p) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id
"""


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by rules, and by a classifier where no rule fits."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


ORACLES["op11_reversed_search"] = r"""
WITH cut AS (
    SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms
    FROM documents),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM cut WHERE len(terms) > 0),
asked AS (
    SELECT item_id, term, count(*)::BIGINT AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
        FROM benchmark) GROUP BY item_id, term),
held AS (
    SELECT row, doc_id, n, term, count(*)::BIGINT AS tf FROM (
        SELECT row, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM cut)
    WHERE term IN (SELECT term FROM asked) GROUP BY row, doc_id, n, term),
weighed AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term) CROSS JOIN corpus),
scored AS (
    SELECT item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM held JOIN weighed USING (term) JOIN asked USING (term) CROSS JOIN corpus GROUP BY item_id, row, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query
def op12_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a factorisation machine that labelled ones train."""
    return factorisation.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document made ready for infilling, and back, as digests."""
    made = infilling.fill_in_middle(table(spark, sf_dir, "documents"))
    back = infilling.restore(made, keep=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


ORACLES["op13_fill_in_middle"] = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents),
drawn AS (
    SELECT *, len(units)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM cut),
formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
    SELECT *, coalesce(array_to_string(units[1 : a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1 : b], ''), '') AS middle,
        coalesce(array_to_string(units[b + 1 : n], ''), '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN body ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
