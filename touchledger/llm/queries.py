"""Registered queries of this package: each applies one operator to its whole table; and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchledger.llm import (collocations, decontaminate, exact, html, language, packing, quality, secrets, simhash,
                             token_counts, toxicity, warc, whitening)
from touchledger.llm.common import prepared, remainder, table
from touchledger.plans.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return packing.pack(docs, packing.byte_bpe()).drop("key", "ids")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(prepared(spark), sf_dir, "pages"), f"{Workspace(spark).root}/warc"
    warc.register(spark)
    warc.records_of(pages).write.format("warc").mode("append").save(folder)
    schema = "record_type string, record_id string, refers_to string, payload_digest string, payload_bytes bigint"
    read = spark.read.format("warc").schema(schema).option("verify", "true").option("partitionBytes", 16 << 20)
    return read.load(folder).select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to").alias("refers_to"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    model = language.LanguageModel.fit(docs.where(language.is_training(F.col("doc_id"))))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score",
                        "ambiguous")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(prepared(spark), sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, workspace = table(prepared(spark), sf_dir, "documents"), Workspace(spark)
    index = exact.DigestIndex(spark, f"{workspace.root}/digest_index")
    return index.add(docs, workspace).select("doc_id", "keep_id", "group_size", "kept",
                                             F.lower(F.hex("digest")).alias("text_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(prepared(spark), sf_dir, n) for n in ("documents", "labels"))
    return quality.judge(docs, labels.where("quality = 1"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(prepared(spark), sf_dir, "documents").select("doc_id", "text")).drop("text")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(prepared(spark), sf_dir, n) for n in ("documents", "labels"))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(prepared(spark), sf_dir, n) for n in ("documents", "benchmark"))
    hits = decontaminate.find_hits(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                       (F.size("spans") > 0).alias("contaminated"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(prepared(spark), sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(prepared(spark), sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, token_counts.byte_bpe()).drop("text")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_packing, op2_warc, op3_simhash, op4_language, op5_html, op6_exact_dedup, op7_quality, op8_secrets,
    op9_toxicity, op10_decontamination, op11_whitening, op12_collocations, op13_token_counts)}

ORACLES = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_decontamination": r"""
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
            FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
            FROM benchmark WHERE text IS NOT NULL),
        windows AS (
            SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS run
            FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                  FROM (SELECT *, least(len(w), 10) AS size FROM item_words WHERE len(w) > 0))),
        sizes AS (SELECT DISTINCT size FROM windows),
        runs AS (
            SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS run
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                  FROM doc_words, sizes WHERE len(w) >= size)),
        hits AS (SELECT doc_id, i, size, item_id FROM runs JOIN windows USING (size, run)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                    FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS list
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
            FROM documents),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        phrases AS (
            SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
            FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
                  FROM pieces, range(1, 6) sizes(size) WHERE len(w) >= size)),
        counts AS (SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL HAVING count(*) >= 100),
        cuts AS (
            SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size > 1)),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, n,
                   1000::HUGEINT * c.a * n // (h.f::HUGEINT * t.f) AS score
            FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head
            JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals ON totals.lang = c.lang),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_parts AS (
            SELECT lang, f, array_to_string(w[i:i + part - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, size - part + 2)) AS i
                  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS part
                        FROM counts WHERE size > 2))),
        longer AS (SELECT lang, phrase, max(f) AS f FROM inner_parts GROUP BY lang, phrase),
        ranked AS (
            SELECT lang, phrase, a, l, r, n, CAST(score AS BIGINT) AS score,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE longer.f IS NULL OR 100 * longer.f < 100 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
