"""The operators as queries over the given tables, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.llm.collocations import collocations
from cartstream.llm.decontaminate import contamination
from cartstream.llm.exact_dedup import exact_groups
from cartstream.llm.language_id import identify, learn_languages
from cartstream.llm.licenses import license_scan
from cartstream.llm.link_graph import DAMPING, LINK, MARGIN, Rule, judge_pages
from cartstream.llm.minhash import near_groups
from cartstream.llm.packing import pack_documents
from cartstream.llm.quality_ranking import ACCEPT, learn, score
from cartstream.llm.runs import echoed, word_runs
from cartstream.llm.sharding import assign_shards
from cartstream.llm.ship import ship_package
from cartstream.llm.suffix_tree import encode_texts, grow_tree, score_texts
from cartstream.llm.token_cache import token_counts
from cartstream.session import new_run_dir

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op1_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    ranking = learn(docs, _table(spark, folder, "labels"), fold(F.col("doc_id"), 5) != 0)
    return score(docs, docs["doc_id"], ranking).select(
        F.col("carried").alias("doc_id"),
        (F.coalesce(fold(F.col("carried"), 5), F.lit(1)) == 0).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def op2_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 7), F.lit(0)) == 2
    texts = encode_texts(docs, docs["doc_id"], ~held_out)
    scores = score_texts(texts, grow_tree(texts)).withColumnRenamed("carried", "doc_id")
    return scores.select("doc_id", held_out.alias("held_out"), *scores.columns[1:])


# The rules that pages are judged by.
URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def op3_link_graph(spark: SparkSession, folder: str) -> DataFrame:
    return judge_pages(_table(spark, folder, "pages"), URL_RULES)


def op4_minhash_stars(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_groups(_table(spark, folder, "documents"), words=4)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(_table(spark, folder, "documents")).drop("shorter")


def op6_token_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of all documents, with a cache that an earlier call on some of them
    has filled in part: contents are hits, copies of hits, and misses."""
    docs, cache = _table(spark, folder, "documents"), new_run_dir(spark, "token-cache")
    earlier = docs.where(F.coalesce(fold(F.col("doc_id"), 4), F.lit(0)) == 0)
    token_counts(earlier, TOKENIZER, cache)
    return token_counts(docs, TOKENIZER, cache)


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_table(spark, folder, "documents"), TOKENIZER)


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(_table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    return assign_shards(_table(spark, folder, "documents"), 16)


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(_table(spark, folder, "documents"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    texts = docs.select("doc_id", echoed(F.coalesce("text", F.lit("")), number).alias("text"))
    # Of equal exponents the first run; doubles tell fractions of word counts apart.
    best = F.array_min(
        F.transform("runs", lambda r: F.struct(-r["length"] / r["period"], r["start"], r["period"], r["length"]))
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (
        word_runs(texts, texts["doc_id"])
        .withColumn("best", best)
        .select(
            F.col("carried").alias("doc_id"),
            F.size("runs").cast("long").alias("n_runs"),
            F.col("best.start").alias("start"),
            F.col("best.length").alias("length"),
            F.col("best.period").alias("period"),
            F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
            F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


def op13_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    # Without a doc_id a row is in no fold: it is not held out.
    held_out = F.coalesce(fold(F.col("doc_id"), 5), F.lit(1)) == 0
    languages = learn_languages(docs.where(~held_out))
    found = identify(docs, docs["doc_id"], languages).withColumnRenamed("carried", "doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


def queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_quality_ranking,
            op2_suffix_tree,
            op3_link_graph,
            op4_minhash_stars,
            op5_exact_dedup,
            op6_token_cache,
            op7_best_fit_packing,
            op8_license_scan,
            op9_decontamination,
            op10_rendezvous_shards,
            op11_phrase_collocations,
            op12_periodic_runs,
            op13_language_mixture,
        )
    }


# Steps after which ranks move by no more than 0.5^40 of the seeds.
SQL_STEPS = 40


def _links_sql() -> str:
    """The ranks step by step, one table expression each, until they stand still."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
    link = LINK.replace("'", "''")
    steps = "".join(
        f"""
            r{i} AS (
                SELECT kind, node, sum(value) AS value FROM (
                    SELECT kind, node, {1 - DAMPING} * value AS value FROM r0
                    UNION ALL
                    SELECT e.kind, e.dst, r.value * e.share
                    FROM edges e JOIN r{i - 1} r ON r.kind = e.kind AND r.node = e.src
                ) GROUP BY kind, node
            ),"""
        for i in range(1, SQL_STEPS + 1)
    )
    return rf"""
        WITH rest AS (
            SELECT row_number() OVER () AS n, page_id, coalesce(html, '') AS html,
                   CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT n, page_id, html, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ), rules(verdict, host, path) AS (VALUES {rules}
        ), judged AS (
            SELECT n, max(r.host || r.path) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
            FROM parts p JOIN rules r
              ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
            WHERE NOT EXISTS (
                SELECT 1 FROM rules l
                WHERE (p.host = l.host OR ends_with(p.host, '.' || l.host)) AND starts_with(p.path, l.path)
                  AND length(l.host || l.path) > length(r.host || r.path)
            )
            GROUP BY n
        ), linked AS (
            SELECT DISTINCT host AS src, {lower.format("target")} AS dst
            FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS target FROM parts)
            WHERE host != '' AND target != '' AND host != {lower.format("target")}
        ), hosts AS (
            SELECT host, string_split(host, '.') AS l FROM (
                SELECT host FROM parts WHERE host != '' UNION SELECT dst FROM linked
            )
        ), site AS (
            SELECT DISTINCT array_to_string(l[i:], '.') AS sub, array_to_string(l[i + 1:], '.') AS host
            FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM hosts)
        ), links AS (
            SELECT src, dst FROM linked UNION SELECT sub, host FROM site UNION SELECT host, sub FROM site
        ), net AS (
            SELECT host AS node, avg(CASE verdict WHEN 'allow' THEN 1.0 WHEN 'block' THEN -1.0 ELSE 0.0 END) AS net
            FROM parts LEFT JOIN judged USING (n) WHERE host != '' GROUP BY host
        ), r0 AS (
            SELECT CASE WHEN net > 0 THEN 'allow' ELSE 'block' END AS kind, node, abs(net) AS value
            FROM net WHERE net != 0
        ), ways AS (
            SELECT 'allow' AS kind, src, dst FROM links UNION ALL SELECT 'block', dst, src FROM links
        ), ends AS (
            SELECT kind, node FROM r0 UNION SELECT kind, dst FROM ways
            EXCEPT SELECT kind, src FROM ways
        ), edges AS (
            SELECT kind, src, dst, {DAMPING} / count(*) OVER (PARTITION BY kind, src) AS share FROM (
                SELECT * FROM ways UNION ALL SELECT kind, node, node FROM ends
            )
        ),{steps}
        blocked AS (
            SELECT node AS host FROM r{SQL_STEPS} GROUP BY node
            HAVING sum(CASE kind WHEN 'block' THEN value ELSE -value END) > {MARGIN}
        )
        SELECT page_id, p.host, path, rule,
               coalesce(verdict, CASE WHEN b.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
        FROM parts p LEFT JOIN judged USING (n) LEFT JOIN blocked b ON b.host = p.host
    """


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Exact: sets as rows, pairs by the shingles they share, all that can be reached.
NEAR_SQL = rf"""
    WITH RECURSIVE docs AS (
        SELECT row_number() OVER () AS n, doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), runs AS (
        SELECT n, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0
    ), shingles AS (
        SELECT DISTINCT n, array_to_string(w[i:i + 3], ' ') AS shingle FROM runs
    ), sizes AS (
        SELECT n, count(*) AS size FROM shingles GROUP BY n
    ), shared AS (
        SELECT a.n AS a, b.n AS b, count(*) AS n_shared
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.n != b.n GROUP BY a.n, b.n
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.n = a JOIN sizes y ON y.n = b
        WHERE 100 * n_shared >= 80 * (x.size + y.size - n_shared)
    ), reached AS (
        SELECT n, n AS m FROM docs UNION SELECT n, b FROM reached JOIN links ON a = m
    ), least AS (
        SELECT r.n, min(d.doc_id) AS component_id FROM reached r JOIN docs d ON d.n = r.m GROUP BY r.n
    )
    SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM docs JOIN least USING (n) LEFT JOIN sizes USING (n)
"""

LEAKS_SQL = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS n, doc_id,
               regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), items AS (
        SELECT CAST(item_id AS VARCHAR) AS item,
               regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), windows AS (
        SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS words
        FROM (
            SELECT *, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
            FROM items WHERE len(w) > 0
        )
    ), stretches AS (
        SELECT n, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
        FROM (
            SELECT n, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM docs JOIN (SELECT DISTINCT size FROM windows) ON len(w) >= size
        )
    ), found AS (
        SELECT n, i, size, item FROM stretches JOIN windows USING (size, words)
    ), hits AS (
        SELECT n, count(DISTINCT place) AS n_hit
        FROM (SELECT n, unnest(range(i, i + size)) AS place FROM found) GROUP BY n
    ), names AS (
        SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT n, item FROM found) GROUP BY n
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hits USING (n) LEFT JOIN names USING (n)
"""


def phrases_sql(least: int = 100, top: int = 2000) -> str:
    """All phrases counted as rows, every cut and every phrase inside another."""
    return rf"""
        WITH cut AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), pieces AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut
        ), grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
                SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
            )
        ), counts AS (
            SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase
        ), words AS (
            SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
        ), candidates AS (
            SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE k > 1 AND f >= {least}
        ), cuts AS (
            SELECT c.lang, c.phrase, c.a, place, l.f AS l, r.f AS r, n,
                   (1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS score
            FROM (SELECT *, unnest(range(1, k)) AS place FROM candidates) c
            JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:place], ' ')
            JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[place + 1:], ' ')
            JOIN words ON words.lang = c.lang
        ), lowest AS (
            SELECT * FROM cuts
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1
        ), inside AS (
            SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer FROM (
                SELECT *, unnest(range(1, k - size + 2)) AS i
                FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates)
            ) GROUP BY ALL
        ), ranked AS (
            SELECT lang, phrase, a, l, r, n, score,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM lowest LEFT JOIN inside USING (lang, phrase)
            WHERE longer IS NULL OR 100 * longer < 100 * a
        )
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked WHERE rank <= {top}
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op11_phrase_collocations": phrases_sql(),
        "op3_link_graph": _links_sql(),
        "op4_minhash_stars": NEAR_SQL,
        "op9_decontamination": LEAKS_SQL,
        "op5_exact_dedup": r"""
            WITH rows AS (
                SELECT doc_id, length(coalesce(text, '')) AS n_points,
                       regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
                FROM documents
            ), ranked AS (
                SELECT doc_id, sha256(plain) AS text_sha256,
                       first_value(doc_id) OVER best AS keep_id,
                       row_number() OVER best = 1 AS kept,
                       count(*) OVER (PARTITION BY plain) AS group_size
                FROM rows
                WINDOW best AS (
                    PARTITION BY plain ORDER BY n_points DESC, doc_id NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING
                )
            )
            SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
        """,
    }
