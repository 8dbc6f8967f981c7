"""The text operators as registered queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.llm import (
    bpe, classifier, exactdedup, lexical, packing, pii, quality, resample, sharding, simhash, tokens,
    urlfilter, warc,
)
from caselens.llm.common import table, text_or_empty
from caselens.session import shared_folder


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    printed = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return urlfilter.judge(pages, urlfilter.SITES + urlfilter.SPAM_HOSTS)


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents")).select(
        "doc_id", "size",
        F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.token_counts(table(spark, folder, "documents"), path)


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return classifier.scored(table(spark, folder, "documents"), labels)


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.exact_groups(spark, f"{folder.rstrip('/')}/documents.parquet")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(table(spark, folder, "documents"), path)
    return packing.packed(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


def op9_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All pages archived, and the archive copied to a replica. So that the audit has something to
    find, about one in a hundred page bodies, chosen by its hash, loses its last byte's value."""
    out = shared_folder(spark)
    warc.write_archive(table(spark, folder, "pages"), f"{out}/archive")
    chosen = (F.col("body") != "") & (F.pmod(F.xxhash64("body"), F.lit(100)) == 0)
    spoiled = F.expr("concat(left(body, length(body) - 1), '~')")
    warc.copy_archive(
        spark, f"{out}/archive", f"{out}/replica",
        F.when(chosen, spoiled).otherwise(F.col("body")),
    )
    return warc.audited(spark, f"{out}/archive", f"{out}/replica").withColumn(
        "digest", F.lower(F.hex("digest"))
    )


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(table(spark, folder, "documents"), path).select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    """``n_*`` count the base spans; ``n_added`` counts those that the model adds."""
    found = pii.found_spans(table(spark, folder, "documents"))

    def printed(spans):
        # By start, then by the kind's place among the kinds.
        kinds = F.array(*map(F.lit, pii.KINDS))
        keyed = F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("place"),
            F.concat_ws(":", s["kind"], s["start"], s["stop"]).alias("name"),
        ))
        return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["name"]), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(printed(F.col("spans")), 256).alias("base_sha256"),
        printed(F.concat("spans", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_url_filter": op2_url_filter,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_token_counts": op5_token_counts,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_warc_audit": op9_warc_audit,
    "op10_bpe": op10_bpe,
    "op11_pii": op11_pii,
    "op12_resample": op12_resample,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE: dict[str, str] = {
    "op7_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               sha256(body) AS text_sha256
        FROM rows WINDOW same AS (PARTITION BY body)
    """,
    "op2_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ),
        ruled AS (
            SELECT page_id, host, path,
                   CASE WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%'
                             THEN 'example.org/en/1'
                        WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%'
                             THEN 'example.org/es/'
                        WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
                        WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
                        WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/'
                   END AS rule
            FROM parts
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
                    WHEN rule IS NOT NULL THEN 'block'
                    WHEN regexp_matches(host,
                        '(^|[.-])(casino|bets|pills|viagra|spam|adult|xxx|porn|ads-track)([.-]|$)')
                        THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM ruled
    """,
    "op12_resample": r"""
        WITH crc_table AS (
            SELECT list(value ORDER BY byte) AS steps FROM (
                SELECT byte, list_reduce(
                           list_prepend(byte, [0, 0, 0, 0, 0, 0, 0, 0]),
                           lambda v, x: xor(v >> 1, 3988292384 * (v & 1))
                       ) AS value
                FROM (SELECT unnest(range(256)) AS byte)
            )
        ),
        texts AS (
            SELECT 'd' AS side, rowid AS id, text FROM (SELECT row_number() OVER () AS rowid, text
                                                        FROM documents)
            UNION ALL
            SELECT 'b', 0, text FROM benchmark
        ),
        found AS (
            SELECT side, id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM texts
        ),
        words AS (SELECT side, id, word, count(*) AS times FROM found GROUP BY ALL),
        coded AS (
            SELECT word, hex(encode(word)) AS code FROM (SELECT DISTINCT word FROM words)
        ),
        hashed AS (
            SELECT word, xor(4294967295, list_reduce(
                       list_prepend(4294967295, list_transform(
                           range(length(code) // 2),
                           lambda i: ('0x' || substr(code, 2 * i + 1, 2))::BIGINT)),
                       lambda r, x: xor(r >> 8, steps[(xor(r, x) & 255) + 1]))) % 10000 AS bucket
            FROM coded, crc_table
        ),
        placed AS (
            SELECT side, id, bucket, sum(times)::BIGINT AS times FROM words JOIN hashed USING (word)
            GROUP BY ALL
        ),
        counts AS (
            SELECT bucket, coalesce(sum(times) FILTER (side = 'd'), 0)::BIGINT AS s,
                   coalesce(sum(times) FILTER (side = 'b'), 0)::BIGINT AS t
            FROM placed GROUP BY bucket
        ),
        totals AS (SELECT sum(s)::DOUBLE AS total_s, sum(t)::DOUBLE AS total_t FROM counts),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (total_s + 10000)
                                 / ((s + 1)::DOUBLE * (total_t + 10000))))::BIGINT AS gain
            FROM counts, totals
        ),
        weights AS (
            SELECT id, sum(times)::BIGINT AS n, sum(times * gain)::BIGINT AS total
            FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
        ),
        scored AS (
            SELECT doc_id, coalesce(n, 0) AS n_features,
                   coalesce((total - ((total % n + n) % n)) // n, 0) AS weight,
                   floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8)
                                          )::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
            FROM (SELECT doc_id, row_number() OVER () AS id FROM documents) LEFT JOIN weights USING (id)
        ),
        summed AS (SELECT doc_id, n_features, weight, weight + noise AS score FROM scored),
        placed_rows AS (
            SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER () AS able
            FROM summed WHERE n_features >= 20
        )
        SELECT s.doc_id, s.n_features, s.weight, s.score,
               CASE WHEN place <= 10 * able // 100 THEN place END AS rank
        FROM summed s LEFT JOIN placed_rows p USING (doc_id)
    """,
    "op13_lexical_search": r"""
        WITH found AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id),
        whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes),
        asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark) GROUP BY ALL
        ),
        held AS (SELECT doc_id, term, count(*) AS tf FROM found
                 WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM held, whole GROUP BY term, docs
        ),
        impacts AS (
            SELECT doc_id, term,
                   (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length)) AS impact
            FROM held JOIN sizes USING (doc_id), whole
        ),
        scores AS (
            SELECT item_id, doc_id, sum(times * w * impact)::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL
        ),
        ranks AS (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
    """,
}
