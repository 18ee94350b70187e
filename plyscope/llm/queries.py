"""The registered query of every operator, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plyscope.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import bpe

    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, vocabulary("byte_bpe_50k.json"), decoded=True, keep_text=False)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op2_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import warc

    read = warc.read_archives(warc.write_archives(table(spark, folder, "pages"))).where("kind = 'record'")
    own = F.col("payload").isNotNull()
    return read.select(
        F.col("record_key").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


SQL["op2_warc_salvage"] = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
    SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest
)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
    CASE WHEN f.first IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 100
"""


@query
def op3_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import lm

    return lm.scored(table(spark, folder, "documents"))


@query
def op4_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import lsh

    return lsh.nearest(table(spark, folder, "embeddings"), k=20, every=20)


@query
def op5_compression_distance(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import toxicity

    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


#: The conversation whose texts hold control strings.
TRICKY = (-7, "\\### Assistant: </turn> ok")


@query
def op6_chat_parts(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import chat

    rows = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long"), "role", "text")
    tricky = [F.struct(F.lit(n).cast("long").alias("turn"), F.lit(role).alias("role")) for n, role in enumerate(("user", "assistant"))]
    added = spark.range(1).select(F.lit(TRICKY[0]).cast("long").alias("conv_id"), F.explode(F.array(*tricky)).alias("t"))
    rows = rows.unionByName(added.select("conv_id", "t.turn", "t.role", F.lit(TRICKY[1]).alias("text")))
    done = chat.format_chat(rows.withColumn("parts", chat.text_part(F.col("text"))))
    turns = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    return done.withColumns({"_turns": turns, "_loss": loss}).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", "_turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL["op6_chat_parts"] = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
    SELECT *, length(role) + length(text)
        + length(regexp_replace(role || text, '[^<>\\]', '', 'g')) + length('<turn >') + 1 + length('</turn>') + 1 AS formatted
    FROM c
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op7_line_similarity_join(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import lines

    done = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), least=1)
    return done.select(
        "doc_id",
        "n_lines",
        "n_removed",
        "links",
        "direct_links",
        "class_id",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


@query
def op8_probminhash(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import minhash

    return minhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "links")


@query
def op9_branch_and_bound(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import topk, vectors

    rows = vectors.whole_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * 256).cast("double")))
    found = topk.exact_top_k(rows.where(vectors.is_query(F.col("id"), 50)), rows, k=5)
    return found.withColumn("score", F.col("score").cast("long"))


SQL["op9_branch_and_bound"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.c, p.c) AS BIGINT) AS score
    FROM v q JOIN v p ON q.vec_id <> p.vec_id AND len(q.c) = len(p.c) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query
def op10_differencing_windows(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import packing

    pieces = packing.token_pieces(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(digests)


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


@query
def op11_jacobi_davidson(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import whitening

    return whitening.whitened(table(spark, folder, "embeddings"))


@query
def op12_spanning_tree_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import negatives

    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.labelled_vectors(rows.withColumn("label", moved)))


SQL["op12_spanning_tree_negatives"] = """
WITH v AS (
    SELECT DISTINCT CAST(vec_id AS BIGINT) AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.id AS anchor_id, a.label AS anchor_label, x.id, x.label, CAST(list_inner_product(a.c, x.c) AS BIGINT) AS score
    FROM v a JOIN v x ON a.id <> x.id AND len(a.c) = len(x.c) WHERE a.id % 100 = 0
), p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
    s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query
def op13_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    from plyscope.llm import fingerprints

    return fingerprints.edited(table(spark, folder, "documents"))
