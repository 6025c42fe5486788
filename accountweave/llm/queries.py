"""The registered queries of this package, each over the whole of its tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountweave.llm import (
    chunk_bpe,
    cross_align,
    discriminant,
    interleave,
    line_chunks,
    order_minhash,
    prefix_trie,
    repeated_bytes,
    rotated_codes,
    templates,
    token_files,
    warc,
    weak_toxicity,
)
from accountweave.llm.common import ROW, ship
from accountweave.llm.labels import fold
from accountweave.session import checkpoint_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _files(spark: SparkSession, name: str) -> str:
    """A new shared folder for the files of one run."""
    return checkpoint_folder(spark, f"staged/{name}-{uuid.uuid4().hex}")


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_bytes.remove_repeats(_table(spark, sf_dir, "documents"), length=400, keep="none")
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _files(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated_codes.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = weak_toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    held_out = (fold("doc_id", weak_toxicity.FOLDS) == weak_toxicity.HELD_OUT).alias("held_out")
    out = docs.select("doc_id", held_out, weak_toxicity.scorer(docs, model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= weak_toxicity.THRESHOLD).cast("int"))


def op5_discriminant_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = discriminant.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    held_out = (fold("id", discriminant.FOLDS) == discriminant.HELD_OUT).alias("held_out")
    predicted = (F.col("score") >= discriminant.THRESHOLD).cast("int").alias("predicted")
    return out.select(F.col("id").alias("doc_id"), held_out, "score", predicted)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _files(spark, "token-files")
    token_files.write_ids(_table(spark, sf_dir, "documents"), path)
    return token_files.with_starts(token_files.read_ids(spark, path, ids=False))


def op7_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = templates.flag(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.transform("items", lambda i: i.cast("long"))
    return out.select(F.col(f"{ROW}.doc_id").alias("doc_id"), (F.col("n_items") > 0).alias("contaminated"), "n_items", F.round("cover", 4).alias("cover"), F.array_sort(items).alias("item_ids"))


def op8_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.round_trip(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_chunks.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select(F.col(f"{ROW}.doc_id").alias("doc_id"), "n_lines", "n_removed", "n_chunks", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = order_minhash.groups(_table(spark, sf_dir, "documents"))
    return out.select(F.col("own").alias("doc_id"), "class_id", "class_size")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_hashes(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.paths(*prefix_trie.rebuilt(turns))).withColumnRenamed("saved_bytes", "saved_tokens")


def op12_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interleave.interleave(_table(spark, sf_dir, "documents"))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", grown)


def op13_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cross_align.cross_align(_table(spark, sf_dir, "documents"))
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return out.select(F.col("id").alias("doc_id"), *counts, F.col("groups").alias("groups_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_bytes": op1_repeated_bytes,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_nearest_vectors": op3_nearest_vectors,
    "op4_weak_toxicity": op4_weak_toxicity,
    "op5_discriminant_quality": op5_discriminant_quality,
    "op6_token_files": op6_token_files,
    "op7_template_leaks": op7_template_leaks,
    "op8_chunk_bpe": op8_chunk_bpe,
    "op9_line_chunks": op9_line_chunks,
    "op10_order_minhash": op10_order_minhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_interleave": op12_interleave,
    "op13_cross_align": op13_cross_align,
}

#: CRC-32 in SQL: its table of steps by byte, and the checksum of a list ``bytes``.
_CRC_STEPS = """bits AS (
            SELECT range AS i, 0 AS k, range AS c FROM range(256)
            UNION ALL
            SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
        ), steps AS (
            SELECT list(c ORDER BY i) AS step FROM bits WHERE k = 8
        )"""
_CRC = "xor(list_reduce(bytes, lambda s, x: xor(s >> 8, step[(xor(s, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)"

SQL: dict[str, str] = {
    "op2_warc_revisits": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), o AS (
            SELECT payload_digest, min(page_id) AS original FROM p WHERE payload_bytes >= 100 GROUP BY 1
        )
        SELECT page_id, payload_bytes, p.payload_digest,
            CASE WHEN page_id > original THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > original THEN original END AS refers_to
        FROM p LEFT JOIN o ON p.payload_digest = o.payload_digest AND payload_bytes >= 100
    """,
    "op9_line_chunks": """
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
                string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), l AS (
            SELECT rid, id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d
        ), h AS (
            SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS v FROM l
        ), r AS (
            SELECT *, (v + 31 * coalesce(lag(v, 1) OVER w, 0) + 961 * coalesce(lag(v, 2) OVER w, 0)) % 1000000007 AS rolled
            FROM h WINDOW w AS (PARTITION BY rid ORDER BY pos)
        ), c AS (
            SELECT *, coalesce(sum(CASE WHEN rolled % 4 = 0 THEN 1 ELSE 0 END) OVER (
                PARTITION BY rid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
            FROM r
        ), k AS (
            SELECT rid, id, no, string_agg(line, chr(10) ORDER BY pos) AS chunk, count(*) AS n,
                sum(CASE WHEN trim(line) <> '' THEN 1 ELSE 0 END) AS filled
            FROM c GROUP BY rid, id, no
        ), f AS (
            SELECT chunk, min(id) AS first_id FROM k WHERE filled >= 2 GROUP BY chunk HAVING count(*) > 1
        ), o AS (
            SELECT rid, chunk, min(no) AS own_first FROM k GROUP BY rid, chunk
        ), m AS (
            SELECT k.*, k.filled >= 2 AND f.first_id IS NOT NULL AND NOT (k.id = f.first_id AND k.no = o.own_first) AS gone
            FROM k LEFT JOIN f ON k.chunk = f.chunk JOIN o ON k.rid = o.rid AND k.chunk = o.chunk
        ), s AS (
            SELECT rid, sum(n) AS n_lines, sum(CASE WHEN gone THEN n ELSE 0 END) AS n_removed,
                sum(CASE WHEN gone THEN 1 ELSE 0 END) AS n_chunks,
                coalesce(string_agg(CASE WHEN NOT gone THEN chunk END, chr(10) ORDER BY no), '') AS kept
            FROM m GROUP BY rid
        )
        SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, n_chunks::BIGINT AS n_chunks,
            sha256(kept) AS kept_sha256
        FROM d JOIN s ON d.rid = s.rid
    """,
    "op11_prefix_trie": f"""
        WITH RECURSIVE {_CRC_STEPS}, own AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), ids AS (
            SELECT DISTINCT c, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT) AS bytes FROM own
        ), cut AS (
            SELECT c, {_CRC} % 9 AS h FROM ids, steps
        ), made AS (
            SELECT cut.c, place, role, text FROM cut JOIN own ON own.c = cut.c - cut.c % 5 AND place <= h
            UNION ALL
            SELECT cut.c, place, role, text FROM cut JOIN own ON own.c = cut.c AND place > h
        ), whole AS (
            SELECT ids.c, coalesce(list({{'role': role, 'text': text}} ORDER BY place) FILTER (place IS NOT NULL), []) AS turns
            FROM ids LEFT JOIN made ON made.c = ids.c GROUP BY ids.c
        ), prefixes AS (
            SELECT c, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM whole
        ), nodes AS (
            SELECT list_slice(turns, 1, depth) AS node, depth, min(c) AS conv_id, count(*) AS n_convs, max(n) = depth AS childless,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY node, depth
        ), up AS (
            SELECT node, unnest(range(0, depth + 1)) AS above, depth, childless,
                CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[depth].text) END AS saved
            FROM nodes
        ), sums AS (
            SELECT list_slice(node, 1, above) AS node, sum(childless::INT) AS n_leaves, sum(saved) AS saved_tokens,
                sum((depth = above + 1)::INT) AS n_children
            FROM up GROUP BY list_slice(node, 1, above)
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children::BIGINT AS n_children,
            n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s ON s.node = n.node
        LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = list_slice(n.node, 1, n.depth - 1)
    """,
    "op12_interleave": f"""
        WITH RECURSIVE {_CRC_STEPS}, d AS (
            SELECT doc_id, coalesce('=' || source, '-') AS stratum, coalesce(text, '') AS text,
                hex(encode(coalesce(text, ''))) AS shown
            FROM documents
        ), b AS (
            SELECT doc_id, stratum, strlen(text)::BIGINT + 1 AS size,
                md5('{interleave.SEED} ' || coalesce('=' || doc_id::VARCHAR, '-') || ' ' || text) AS shuffled,
                list_transform(range(0, strlen(text)), lambda i: ('0x' || substr(shown, 2 * i + 1, 2))::BIGINT) AS bytes
            FROM d
        ), n AS (
            SELECT b.*, {_CRC} AS text_crc32
            FROM b, steps
        ), w AS (
            SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY shuffled) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS fraction
            FROM n
        ), o AS (
            SELECT *, row_number() OVER (ORDER BY fraction, stratum, shuffled) - 1 AS number, count(*) OVER () AS total FROM w
        ), s AS (
            SELECT *, number * {interleave.SHARDS} // total AS shard FROM o
        )
        SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
            (number - (shard * total + {interleave.SHARDS - 1}) // {interleave.SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
        FROM s
    """,
}
