"""The registered queries over the training-data tables, and DuckDB SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.llm import (
    alignment, ann, brown_lm, byte_bpe, conversations, decontaminate, exact_dedup, html_text,
    neardup, packing, personal_data, quality, token_counts,
)
from recurra.llm.common import read

PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"
BYTES = "byte_bpe_50k.json"


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages")).drop("path", "votes")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(
        read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)
    )
    return counted.drop("prefix_steps")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(
        read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit_rules(docs, read(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(read(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(read(spark, sf_dir, "documents"))
    return personal_data.digests(found)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return packed.withColumnRenamed("keys", "doc_ids")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_statistics(
        read(spark, sf_dir, "documents"), public_tokenizers.path(BYTES),
        public_tokenizers.path(PIECES),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_summaries(
        conversations.damage(read(spark, sf_dir, "conversations"))
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_html_text, op2_token_counts, op3_nearest, op4_decontamination, op5_byte_bpe,
            op6_quality, op7_near_duplicates, op8_brown_lm, op9_personal_data, op10_packing,
            op11_alignment, op12_conversation_repair, op13_exact_dedup,
        )
    }


#: Weighted Jaccard similarity of every window that begins with a shingle of the item.
DECONTAMINATION_SQL = r"""
WITH words AS (
    SELECT doc_id AS id, 'd' AS kind,
           list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
    FROM documents
    UNION ALL
    SELECT item_id, 'i',
           list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')
    FROM benchmark
),
shingles AS (
    SELECT kind, id, i AS pos, array_to_string(w[i : i + 4], ' ') AS x
    FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
),
items AS (
    SELECT id AS item_id, x, count(*) AS c, sum(count(*)) OVER (PARTITION BY id) AS n
    FROM shingles WHERE kind = 'i' GROUP BY id, x
),
docs AS (SELECT id AS doc_id, pos, x FROM shingles WHERE kind = 'd'),
starts AS (SELECT DISTINCT d.doc_id, d.pos AS start, item_id, n FROM docs d JOIN items USING (x)),
parts AS (
    SELECT s.doc_id, s.start, s.item_id, s.n, d.x, count(*) AS c
    FROM starts s JOIN docs d ON d.doc_id = s.doc_id AND d.pos >= s.start AND d.pos < s.start + s.n
    GROUP BY ALL
),
sized AS (
    SELECT p.doc_id, p.item_id, p.start, max(p.n) AS n, sum(p.c) AS size,
           sum(least(p.c, coalesce(i.c, 0))) AS shared
    FROM parts p LEFT JOIN items i ON i.item_id = p.item_id AND i.x = p.x
    GROUP BY ALL
)
SELECT doc_id, item_id, max(shared / (size + n - shared)) AS similarity
FROM sized WHERE shared / (size + n - shared) >= 0.8 GROUP BY doc_id, item_id
UNION ALL
SELECT DISTINCT d.id, i.id, 1.0 FROM words i JOIN (
    SELECT id, l, array_to_string(w[p : p + l - 1], ' ') AS x
    FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS p
          FROM (SELECT *, unnest([1, 2, 3, 4]) AS l FROM words WHERE kind = 'd'))
) d ON i.kind = 'i' AND len(i.w) = d.l AND array_to_string(i.w, ' ') = d.x
"""


#: All pairs of texts that share a shingle, their exact similarity, and what links reach.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT coalesce(text, '') AS text, min(doc_id) AS node FROM documents GROUP BY 1
),
words AS (
    SELECT node, list_filter(
        regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '') AS w
    FROM texts
),
shingles AS (
    SELECT node, x, count(*) AS c FROM (
        SELECT node, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
            ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS x
        FROM words
    ) GROUP BY node, x
),
sizes AS (SELECT node, sum(c) AS n FROM shingles GROUP BY node),
shared AS (
    SELECT a.node AS u, b.node AS v, sum(least(a.c, b.c)) AS common
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.node < b.node GROUP BY 1, 2
),
links AS (
    SELECT u, v FROM shared JOIN sizes p ON p.node = u JOIN sizes q ON q.node = v
    WHERE common >= 0.8 * (p.n + q.n - common)
),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
    SELECT node AS root, node FROM texts
    UNION
    SELECT root, v FROM reach JOIN edges ON u = node
),
named AS (SELECT node, min(root) AS class_id FROM reach GROUP BY node),
labelled AS (
    SELECT doc_id, class_id FROM documents d JOIN texts t ON t.text = coalesce(d.text, '')
    JOIN named USING (node)
)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS n_class FROM labelled
"""


EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op13_exact_dedup": EXACT_DEDUP_SQL,
        "op4_decontamination": DECONTAMINATION_SQL,
        "op7_near_duplicates": NEAR_DUPLICATES_SQL,
    }
