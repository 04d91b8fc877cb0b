"""The registered queries of the subpackage, and their DuckDB statements where SQL can say them."""

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    bpe,
    collocations,
    exact,
    huffman,
    leaks,
    mixing,
    packing,
    pii,
    piecewise,
    prefix_trie,
    quality,
    simhash,
    urls,
)
from rollcall.llm.common import shipped, table
from rollcall.scratch import scratch_folder

c = F.col
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
QUERIES = {}
STATEMENTS = {}

#: The rules of the url query: block or allow by host and path.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def query(run):
    """Register a query under its name; executors get the package first."""

    @wraps(run)
    def shipped_run(spark, sf_dir):
        return run(shipped(spark), sf_dir)

    QUERIES[run.__name__] = shipped_run
    return shipped_run


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query
def op1_quality(spark, sf_dir):
    return quality.scored(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op2_simhash_dedup(spark, sf_dir):
    groups = simhash.near_groups(_documents(spark, sf_dir), words=3, bits=2)
    return groups.select("doc_id", "fingerprint", "component_id")


@query
def op3_exact_dedup(spark, sf_dir):
    return exact.exact_groups(_documents(spark, sf_dir)).drop("_row")


STATEMENTS["op3_exact_dedup"] = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op4_piecewise(spark, sf_dir):
    return piecewise.compared(_documents(spark, sf_dir))


@query
def op5_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, urls.RULES)
    return urls.judged(table(spark, sf_dir, "pages"), rules)


STATEMENTS["op5_url_filters"] = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), cut AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), fitting AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
           row_number() OVER (
               PARTITION BY page_id, host, path
               ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
    FROM cut LEFT JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM fitting WHERE place = 1
"""


@query
def op6_secret_scans(spark, sf_dir):
    spans = leaks.scanned(_documents(spark, sf_dir))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return spans.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in leaks.BASE_KINDS],
        F.lower(F.sha2(leaks.span_text("base").cast("binary"), 256)).alias("base_sha256"),
        leaks.span_text("spans").alias("spans"),
    )


@query
def op7_byte_bpe(spark, sf_dir):
    tokens = bpe.tokenised(_documents(spark, sf_dir), RANKS)
    digest = lambda column: F.lower(F.sha2(column.cast("binary"), 256))
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        digest(F.array_join(c("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        digest(c("decoded")).alias("decoded_sha256"),
    )


@query
def op8_token_files(spark, sf_dir):
    folder = scratch_folder(spark, "token-files")
    huffman.write_ids(_documents(spark, sf_dir), folder, WORD_VOCABULARY, end_id=1)
    return huffman.read_ids(spark, folder).select(
        c("_id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op9_packing(spark, sf_dir):
    return packing.packed(_documents(spark, sf_dir), WORD_VOCABULARY, end_id=2).drop("ids")


@query
def op10_pii(spark, sf_dir):
    return pii.pseudonymised(_documents(spark, sf_dir), pii.EXAMPLE_KEY)


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(_documents(spark, sf_dir), least=100, top=2000, percent=100)


STATEMENTS["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), places AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM cut
), counted AS (
    SELECT lang, m, words[i : i + m - 1] AS phrase, count(*) AS f
    FROM places, range(1, 6) AS lengths(m)
    WHERE i + m - 1 <= len(words) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, m, phrase, f FROM counted WHERE m > 1 AND f >= 100
), cuts AS (
    SELECT lang, m, phrase, f, unnest(range(1, m)) AS k FROM candidates
), scores AS (
    SELECT c.lang, c.m, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
           (1000 * c.f::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang
    JOIN counted x ON x.lang = c.lang AND x.phrase = c.phrase[1 : c.k]
    JOIN counted y ON y.lang = c.lang AND y.phrase = c.phrase[c.k + 1 : c.m]
), lowest AS (
    SELECT * FROM scores
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
    SELECT c.lang, c.phrase[i : i + w - 1] AS phrase, max(c.f) AS f
    FROM candidates c, range(2, 5) AS widths(w), range(1, 5) AS places(i)
    WHERE w < c.m AND i + w - 1 <= c.m GROUP BY ALL
), ranked AS (
    SELECT s.lang, array_to_string(s.phrase, ' ') AS phrase, a, l, r, n, score,
           row_number() OVER (
               PARTITION BY s.lang
               ORDER BY score DESC, a DESC, encode(array_to_string(s.phrase, ' '))) AS rank
    FROM lowest s LEFT JOIN inner_phrases p ON p.lang = s.lang AND p.phrase = s.phrase
    WHERE p.f IS NULL OR 100 * p.f < 100 * s.a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), family=100, most=5)


STATEMENTS["op12_prefix_trie"] = r"""
WITH own AS (
    SELECT conv_id AS c,
           list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns,
           -- CRC-32 of the decimal id, bit by bit.
           xor(4294967295::BIGINT, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(
                   string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
               lambda crc, octet: list_reduce(
                   list_prepend(xor(crc, octet), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                   lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)
           )) % 6 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
    SELECT o.c, list_concat(coalesce(b.turns[1 : o.h], []), o.turns[o.h + 1 :]) AS path
    FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 100
), members AS (
    SELECT c, path[1 : d] AS node, d, len(path) = d AS ends
    FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ends,
           CASE WHEN d > 0 THEN length(node[d].text) ELSE 0 END AS size
    FROM members GROUP BY node, d
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.node[1 : n.d] = n.node) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.node = n.node[1 : n.d - 1]
)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, n.parent_conv_id::BIGINT AS parent_conv_id,
       n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       count(*) FILTER (WHERE s.n_children = 0)::BIGINT AS n_leaves,
       sum((s.n_convs - 1) * s.size)::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM linked n JOIN linked s ON s.d >= n.d AND s.node[1 : n.d] = n.node
GROUP BY n.node, n.d, n.conv_id, n.parent_conv_id, n.n_convs, n.n_children, n.ends
"""


@query
def op13_mixing(spark, sf_dir):
    found = mixing.copies(_documents(spark, sf_dir), weights=(3, 1, 2), percent=150, most=2)
    return found.drop("_row", "copies")


STATEMENTS["op13_mixing"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce('=' || source, '') AS source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5(concat_ws(':', doc_id::VARCHAR, md5(coalesce(text, '')))) AS entry
    FROM documents
), sources AS (
    SELECT source, sum(size) AS size,
           [3, 1, 2][1 + (row_number() OVER (ORDER BY source = '', source) - 1) % 3] AS weight
    FROM docs GROUP BY source
), levels AS (
    -- In order of size over weight, the sources that stop at twice their size come first.
    SELECT *, sum(weight) OVER () AS w, 150 * sum(size) OVER () AS s,
           coalesce(sum(weight) OVER before, 0) AS w_before,
           coalesce(sum(200 * size) OVER before, 0) AS s_before
    FROM sources
    WINDOW before AS (ORDER BY size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stops AS (
    SELECT *, 200 * size * (w - w_before) <= weight * (s - s_before) AS stop FROM levels
), targets AS (
    SELECT source, size,
           CASE WHEN stop THEN size::DOUBLE * 2
                ELSE weight::DOUBLE * (s - coalesce(sum(200 * size) FILTER (WHERE stop) OVER (), 0))::DOUBLE
                     / (100 * (w - coalesce(sum(weight) FILTER (WHERE stop) OVER (), 0)))::DOUBLE
           END AS target,
           ('0x' || substr(md5('0:' || source), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE AS o
    FROM stops
), rates AS (
    SELECT *, CASE WHEN size > 0 THEN target / size::DOUBLE ELSE 0::DOUBLE END AS rate FROM targets
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, entry) AS k FROM docs
)
SELECT doc_id, p.size::BIGINT AS size, t.size::BIGINT AS source_size, target,
       ((floor(k::DOUBLE * rate + o) - floor((k - 1)::DOUBLE * rate + o))::BIGINT * p.size)::BIGINT AS taken
FROM placed p JOIN rates t ON t.source = p.source
"""


def registered():
    return dict(QUERIES)


def statements():
    return dict(STATEMENTS)
