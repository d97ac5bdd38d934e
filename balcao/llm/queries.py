"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.llm import (
    divergence,
    exact_dedup,
    lloyd,
    mixing,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    superkmer_dedup,
    url_filter,
)
from balcao.session import tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"kept_sha256": F.sha2(F.col("kept"), 256)}
    cut = suffix_dedup.removed(_table(spark, sf_dir, "documents"), window=400, keep="none", outputs=digest)
    n_spans = F.expr("cast(size(spans) div 2 AS long)").alias("n_spans")
    return cut.select("doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(_table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"kept_sha256": F.sha2(F.col("kept"), 256)}
    return superkmer_dedup.removed(_table(spark, sf_dir, "documents"), window=35, outputs=digest).drop("spans")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"), shingle=4, distance=4).drop("h")


#: Share of words that each language is to have.
TARGETS = {"en": 0.55, "fr": 0.17, "de": 0.16, "es": 0.12}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), TARGETS, least=1.0)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_classifier.scores(docs, quality_classifier.fit(docs, _table(spark, sf_dir, "labels")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(_table(spark, sf_dir, "documents"), keep="largest")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=8)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least=3, top=200)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.printed(pii.spans(_table(spark, sf_dir, "documents")))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.clustered(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, salt="3")


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_url_filters,
        op3_quality_rules,
        op4_substring_dedup,
        op5_simhash_near_dedup,
        op6_mixing,
        op7_quality_classifier,
        op8_exact_dedup,
        op9_packing,
        op10_sharding,
        op11_source_divergence,
        op12_pii,
        op13_centroid_clustering,
    )
}

_PATTERNS = " ".join(
    f"WHEN regexp_matches(whole, '{pattern}') THEN '{name}'"
    for name, pattern in (
        # By length of the name, as the longest rule decides.
        ("session id in a query", "(?i)[?&;]phpsessid="),
        ("session id in a path", "(?i);jsessionid="),
        ("shell script folder", "/cgi-bin/"),
        ("gambling host", "(?i)^([^/?#]*[^a-z0-9/?#])?casino([^a-z0-9]|$)"),
        ("program file", r"(?i)\.exe($|[?#])"),
        ("package file", r"(?i)\.apk($|[?#])"),
        ("blog login", r"/wp-login\.php($|[?#])"),
        ("adult host", "(?i)^([^/?#]*[^a-z0-9/?#])?porn([^a-z0-9]|$)"),
    )
)



def _clustering_sql(k: int, rounds: int, dims: int, scale: int, salt: str) -> str:
    """The rounds of Lloyd one after the other, a few common table expressions each."""
    steps = [
        f"""v AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
            FROM embeddings
            WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims}
        ), parts AS MATERIALIZED (SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v
        ), s AS (
            SELECT n, row_number() OVER (ORDER BY sha256('{salt}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM v
        ), c0 AS MATERIALIZED (SELECT c, d, x FROM s JOIN parts USING (n) WHERE c < {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
            SELECT n, arg_min(c, struct_pack(dist := dist, c := c)) AS c, min(dist) AS dist
            FROM (SELECT n, c, sum((p.x - c{i}.x) * (p.x - c{i}.x)) AS dist FROM parts p JOIN c{i} USING (d) GROUP BY n, c)
            GROUP BY n
        )"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
            SELECT c, d, coalesce((total - ((total % times) + times) % times) // times, old.x)::BIGINT AS x
            FROM c{i} old LEFT JOIN (
                SELECT c, d, sum(x)::HUGEINT AS total, count(*) AS times FROM a{i} JOIN parts USING (n) GROUP BY c, d
            ) USING (c, d)
        )"""
            )
    return f"""
        WITH {", ".join(steps)}, digests AS (
            SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c
        )
        SELECT vec_id, c::INTEGER AS cluster, dist::BIGINT AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
               (sum(dist) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a{rounds} JOIN v USING (n) JOIN digests USING (c)
    """


ORACLES = {
    "op2_url_filters": rf"""
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), named AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                   regexp_extract(rest, '(?s)^[^/?#]*(.*)', 1) AS tail
            FROM cut
        ), ruled AS (
            SELECT *, host || tail AS whole,
                   CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM named
        ), judged AS (
            SELECT *, CASE WHEN rule IS NOT NULL THEN NULL {_PATTERNS} END AS pattern FROM ruled
        )
        SELECT page_id, host, path, rule, pattern,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NULL AND pattern IS NOT NULL THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM judged
    """,
    "op4_substring_dedup": r"""
        WITH texts AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT r, head, md5(array_to_string(words[head:head + 34], ' ')) AS sequence
            FROM (SELECT r, words, unnest(generate_series(1, len(words) - 34)) AS head FROM texts)
        ), gone AS (
            SELECT DISTINCT r, unnest(generate_series(head, head + 34)) AS place
            FROM (SELECT r, head FROM windows QUALIFY count(*) OVER (PARTITION BY sequence) > 1)
        ), stay AS (
            SELECT r, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
            FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts) ANTI JOIN gone USING (r, place)
            GROUP BY r
        )
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN stay USING (r)
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size,
               doc_id = max(doc_id) OVER t AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_source_divergence": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), groups AS (SELECT DISTINCT lang, source FROM rows
        ), said AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM rows
        ), kept AS MATERIALIZED (
            SELECT lang, term, count(*) AS n FROM said GROUP BY lang, term HAVING count(DISTINCT r) >= 3
        ), counts AS MATERIALIZED (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
        ), totals AS (
            SELECT lang, source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS total
            FROM groups g
        ), p AS MATERIALIZED (
            SELECT k.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (t.total + s.v) AS p,
                   1 + 1000000000::HUGEINT * (k.n + 1) // (s.total + s.v) AS whole
            FROM kept k JOIN sizes s USING (lang) JOIN totals t USING (lang) LEFT JOIN counts c ON c.lang = k.lang AND c.source = t.source AND c.term = k.term
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(max(f.value), 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
            ) f ON f.lang = a.lang AND f.source = a.source AND f.other = b.source
            GROUP BY ALL
            UNION ALL
            SELECT lang, source, 'term', term, ((p - whole) * (p - whole) // whole)::BIGINT FROM p WHERE n > 0 AND p > whole
        )
        SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM found QUALIFY part = 'pair' OR rank <= 200
    """,
    "op13_centroid_clustering": _clustering_sql(8, 10, 64, 1024, "3"),
}
