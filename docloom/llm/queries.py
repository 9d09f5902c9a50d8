"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The vocabulary of the packing and token queries, a file of the installed public tokenizers.
VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary_path(), CAPACITY, end_id=1)


def op2_hierarchical_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.langid import identify_documents

    return identify_documents(_table(spark, sf_dir, "documents"))


def op3_superminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.neardup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op4_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.sharding import shard_documents, topology

    out = shard_documents(_table(spark, sf_dir, "documents"), topology(16), topology(17))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")


def op5_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.sitetree import main_text

    return main_text(_table(spark, sf_dir, "pages"))


def op6_block_pruned_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(100)) == 0, k=10, scale=1024)


def op7_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot", "first_place")


def op8_latent_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.quality import score_documents

    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.media import audio_digests

    return audio_digests(_table(spark, sf_dir, "documents"))


def op10_feistel_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.tokenout import ordered_digests

    return ordered_digests(_table(spark, sf_dir, "documents"), vocabulary_path(), length=1024, end_id=1)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2:3].isdigit()}


#: A checksum in SQL, as DuckDB has none: the table of the usual reversed polynomial, and a text's bytes folded through it.
_CRC_TABLE = "list_transform(range(0, 256), lambda n: list_reduce(list_prepend(n, range(0, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"


def _tree_sql(shards: int) -> str:
    """The children of the sharding tree's nodes, as rows of (tree, parent, path, weight, shard)."""
    from docloom.llm.sharding import topology

    leaves, rows = topology(shards), {}
    for x in leaves:
        for parent, path, shard in (("", x.region, -1), (x.region, f"{x.region}/{x.rack}", -1), (f"{x.region}/{x.rack}", f"{x.region}/{x.rack}/{x.shard}", x.shard)):
            rows.setdefault((parent, path, shard), 0.0)
            rows[parent, path, shard] += x.weight
    return ", ".join(f"({shards}, '{p}', '{q}', {w}::DOUBLE, {s})" for (p, q, s), w in rows.items())


def _descent_sql(shards: int, level: int) -> str:
    """The node that each document (rid, key) reaches at a level, by the least draw among the children of the one above."""
    above = "(SELECT rid, key, '' AS node FROM d)" if level == 0 else _descent_sql(shards, level - 1)
    draw = "-ln((CAST('0x' || substr(md5(a.key || '/' || t.path), 1, 13) AS BIGINT) + 1.0) / 4503599627370497.0) / t.weight"
    return f"(SELECT a.rid, any_value(a.key) AS key, arg_min(t.path, {draw}) AS node, arg_min(t.shard, {draw}) AS shard FROM {above} a JOIN tree t ON t.n = {shards} AND t.parent = a.node GROUP BY a.rid)"


#: Tokenizers, learnt models, pages and audio have no SQL form; those operators are tested against plain code.
ORACLE_SQL: dict[str, str] = {
    "op3_superminhash_near_duplicates": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), tokens AS (SELECT doc_id, len(w) AS n, unnest(w) AS t, unnest(range(len(w))) AS i FROM words
        ), runs AS (  -- of four words, fewer where the text has fewer
            SELECT doc_id, n, i, md5(concat_ws(' ', t, lead(t, 1) OVER o, lead(t, 2) OVER o, lead(t, 3) OVER o)) AS x FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ), shingles AS MATERIALIZED (SELECT DISTINCT doc_id, x FROM runs WHERE i <= greatest(n - 4, 0)
        ), sizes AS MATERIALIZED (SELECT d.doc_id, count(s.x) AS n FROM documents d LEFT JOIN shingles s ON s.doc_id = d.doc_id GROUP BY d.doc_id
        ), prefixes AS (  -- the rarest shingles that two sets of similarity 0.8 cannot both miss
            SELECT doc_id, x FROM (SELECT s.doc_id, s.x, n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.c, s.x) AS place FROM shingles s JOIN (SELECT x, count(*) AS c FROM shingles GROUP BY x) f ON f.x = s.x JOIN sizes z ON z.doc_id = s.doc_id) WHERE place <= n - ceil(0.8 * n) + 1
        ), candidates AS MATERIALIZED (
            SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefixes a JOIN prefixes b ON b.x = a.x AND b.doc_id > a.doc_id
        ), shared AS (
            SELECT c.a, c.b, count(*) AS n_both FROM candidates c JOIN shingles x ON x.doc_id = c.a JOIN shingles y ON y.doc_id = c.b AND y.x = x.x GROUP BY 1, 2
        ), links AS MATERIALIZED (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)
        ), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b
        )
        SELECT z.doc_id, z.n AS n_shingles, min(r.b) AS component_id, z.doc_id = min(r.b) AS kept FROM sizes z JOIN reach r ON r.a = z.doc_id GROUP BY z.doc_id, z.n
    """,
    "op4_weighted_hash_tree": f"""
        WITH tree(n, parent, path, weight, shard) AS (VALUES {_tree_sql(16)}, {_tree_sql(17)}), crc AS (SELECT {_CRC_TABLE} AS t),
        d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, coalesce(text, '') AS text, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size FROM documents),
        sums AS (SELECT rid, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(text), '..'), lambda h: CAST('0x' || h AS BIGINT))), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS crc FROM d, crc),
        placed AS (SELECT d.doc_id, d.size, CAST(s.crc AS BIGINT) AS text_crc32, p.node, p.shard, g.shard AS grown_shard FROM d JOIN sums s ON s.rid = d.rid JOIN {_descent_sql(16, 2)} p ON p.rid = d.rid JOIN {_descent_sql(17, 2)} g ON g.rid = d.rid)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '/' || text_crc32 || '/' || size)) - 1 AS BIGINT) AS slot, grown_shard,
            string_split(node, '/')[1] AS region, string_split(node, '/')[2] AS rack FROM placed
    """,
    "op7_low_discrepancy_mix": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                md5('1/' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '/' || coalesce(text, '')) AS key FROM documents
        ), sources AS (
            SELECT source, n, no, CASE no % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS no FROM d GROUP BY source)
        ), ranked AS (  -- sources in the order in which they fill up; those before place k are full at level k
            SELECT *, row_number() OVER (ORDER BY 3 * n / w, no) - 1 AS k, coalesce(sum(3 * n) OVER (ORDER BY 3 * n / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_words, sum(w) OVER (ORDER BY 3 * n / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight, (SELECT sum(n) FROM sources) AS total FROM sources
        ), cut AS (
            SELECT min(k) AS k FROM ranked WHERE (total - full_words) * w / open_weight <= 3 * n
        ), level AS (
            SELECT CAST(total - full_words AS DOUBLE) AS words, open_weight FROM ranked, cut WHERE ranked.k = cut.k
        ), targets AS (
            SELECT r.no, r.source, r.n, CASE WHEN r.k < c.k THEN CAST(3 * r.n AS DOUBLE) ELSE l.words * r.w / l.open_weight END AS target, r.total, greatest(1, least(2048, CAST(r.total AS BIGINT) // 65536)) AS block FROM ranked r, cut c, level l
        ), edges AS (
            SELECT no, CASE WHEN no = max(no) OVER () THEN 4611686018427387904 ELSE least(4611686018427387904, CAST(trunc(sum(target) OVER (ORDER BY no) / sum(target) OVER () * 4611686018427387904::DOUBLE) AS HUGEINT)) END AS up FROM targets
        ), slots AS (
            SELECT s.slot, (SELECT min(no) FROM edges WHERE up > (CAST(s.slot + 1 AS HUGEINT) * 2850178704830799621) % 4611686018427387904) AS no FROM (SELECT unnest(range(0, (SELECT CAST(ceil(max(total) / max(block)) AS BIGINT) FROM targets))) AS slot) s
        ), played AS (
            SELECT slot, no, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS block_no FROM slots
        ), tape AS (
            SELECT d.rid, d.doc_id, d.size, t.no, t.n, t.target, t.block, coalesce(sum(d.size) OVER (PARTITION BY t.no ORDER BY d.key, d.rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source
        ), turns AS (
            SELECT *, CAST(start + turn * n AS BIGINT) AS a, CAST(start + turn * n + size AS BIGINT) AS b FROM tape, (SELECT unnest(range(0, 3)) AS turn) WHERE size > 0
        ), parts AS (
            SELECT rid, no, block, a, b, unnest(range(a // block, (b - 1) // block + 1)) AS block_no FROM turns
        ), taken AS (
            SELECT p.rid, sum(least(b, (p.block_no + 1) * block) - greatest(a, p.block_no * block)) AS words, min(s.slot) AS first_slot, min(s.slot * block + greatest(a, p.block_no * block) - p.block_no * block) AS first_place
            FROM parts p JOIN played s ON s.no = p.no AND s.block_no = p.block_no GROUP BY p.rid
        )
        SELECT t.doc_id, t.size, t.n AS source_size, t.target, CAST(coalesce(k.words, 0) AS BIGINT) AS taken, k.first_slot, CAST(k.first_place AS BIGINT) AS first_place FROM tape t LEFT JOIN taken k ON k.rid = t.rid
    """,
    "op6_block_pruned_top_k": """
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS terms
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(coalesce(list_sum(list_transform(list_zip(q.terms, c.terms, true), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
            FROM kept q JOIN kept c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
}
