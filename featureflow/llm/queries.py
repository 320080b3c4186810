"""Registered queries of the operators, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .bpe import encode_texts
from .brown import score_texts
from .langid import identify_languages
from .mixing import mix
from .nearest import nearest_neighbours
from .neardup import near_duplicates
from .quality import score_quality
from .rollup import commit, token_count, totals
from .topk import top_scores
from .toxicity import score_toxicity
from .variants import spelling_variants
from .warc import archived_pages
from .whitening import whiten

#: Tokenizer file of the encoding query.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_read(spark, sf_dir, "pages"), work_path(spark, "archives")).drop("valid")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def _remainder(divisor: int) -> F.Column:
    """CRC-32 of the document's id as text, modulo the divisor; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def quality_weights(labels: DataFrame) -> DataFrame:
    """Sampling weights of labelled documents: those of good quality are drawn four times as readily as bad ones."""
    weight = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5)
    return labels.select("doc_id", weight.alias("weight"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_read(spark, sf_dir, "documents"), quality_weights(_read(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_read(spark, sf_dir, "documents"), held_out=_remainder(5) == 1)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_read(spark, sf_dir, "embeddings"))


def op6_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(_read(spark, sf_dir, "embeddings"))


def op7_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, a fourth is counted anew by the second tokenizer, a tenth goes; one batch is sent twice."""
    docs = _read(spark, sf_dir, "documents").where("doc_id is not null")
    kept = ["doc_id", "source", "lang", "deleted", "version", "tokens"]

    def counted(rows: DataFrame, version: str, deleted: bool = False) -> DataFrame:
        tokens = F.lit(0) if deleted else token_count("text", version)
        return rows.withColumns({"deleted": F.lit(deleted), "version": F.lit(version), "tokens": tokens}).select(kept)

    path = work_path(spark, "token-totals")
    revised = counted(docs.where(F.pmod("doc_id", F.lit(4)) == 1), "words-2")
    commit(counted(docs, "words-1"), path, 0)
    commit(revised, path, 1)
    commit(counted(docs.where(F.pmod("doc_id", F.lit(10)) == 3), "words-1", deleted=True), path, 2)
    commit(revised, path, 1)
    return totals(spark, path, 3)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return score_toxicity(docs, labels, held_out=_remainder(5) == 0)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(_read(spark, sf_dir, "documents"), TOKENIZER)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_read(spark, sf_dir, "documents"), held_out=_remainder(3) == 1)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_read(spark, sf_dir, "embeddings"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_read(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return score_quality(docs, labels, held_out=_remainder(3) == 1)


QUERIES = {
    "op1_archives": op1_archives,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_mix": op3_mix,
    "op4_class_scores": op4_class_scores,
    "op5_nearest": op5_nearest,
    "op6_top_scores": op6_top_scores,
    "op7_token_totals": op7_token_totals,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_languages": op10_languages,
    "op11_whitening": op11_whitening,
    "op12_variants": op12_variants,
    "op13_quality": op13_quality,
}

SQL: dict[str, str] = {
    "op1_archives": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS n, sha1(html) AS digest FROM p),
        m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS latest FROM d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN latest IS NOT NULL AND page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
        FROM m
    """,
    "op3_mix": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
        ),
        q AS (
            SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE END) AS weight FROM labels GROUP BY doc_id
        ),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
            FROM d GROUP BY source
        ),
        l AS (
            SELECT *, 2.0::DOUBLE * source_size AS lim,
                   (1.5::DOUBLE * sum(source_size) OVER ()
                    - coalesce(sum(2.0::DOUBLE * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM s WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST)
        ),
        t AS (
            SELECT source, source_size,
                   CASE WHEN lim <= w * level THEN lim
                        ELSE least(lim, w * max(CASE WHEN lim > w * level THEN level END) OVER ()) END AS target
            FROM l
        ),
        e AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t
        ),
        k AS (
            SELECT d.*, -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
                        / 4503599627370496.0::DOUBLE) / coalesce(q.weight, 1.0::DOUBLE) AS key
            FROM d LEFT JOIN q USING (doc_id)
        ),
        b AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k
        )
        SELECT doc_id, size, source_size, target,
               CAST(size * (epochs + CASE WHEN start + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source
    """,
    "op7_token_totals": r"""
        WITH d AS (
            SELECT source, lang, CASE WHEN doc_id % 4 IN (1, -3) THEN 'words-2' ELSE 'words-1' END AS version, coalesce(text, '') AS text
            FROM documents WHERE doc_id IS NOT NULL AND doc_id % 10 NOT IN (3, -7)
        )
        SELECT source, lang, version, count(*) AS docs,
               CAST(sum(len(CASE version WHEN 'words-1' THEN regexp_extract_all(text, '[^\x20\x09-\x0D]+')
                            ELSE regexp_extract_all(text, '\p{L}+|\p{N}+|[^\p{L}\p{N}\x20\x09-\x0D]') END)) AS BIGINT) AS tokens
        FROM d GROUP BY source, lang, version
    """,
    "op5_nearest": """
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        s AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
    """,
    "op6_top_scores": """
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
    """,
    "op12_variants": r"""
        WITH RECURSIVE r AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents
        ),
        c AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
        x AS (SELECT *, hex(encode(concat(doc_id, ':', run))) AS bytes FROM c),
        h AS (
            SELECT run, n, xor(4294967295::BIGINT, list_reduce(
                [4294967295::BIGINT] || flatten(list_transform(range(len(bytes) // 2),
                    lambda k: [('0x' || substr(bytes, 2 * k + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END)) AS h
            FROM x
        ),
        w AS (
            SELECT CASE WHEN h % 31 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n
            FROM h
        ),
        v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        k AS MATERIALIZED (
            SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest
            FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)
        ),
        d AS (SELECT DISTINCT k.word, k.n, v.word AS near, v.n AS near_n FROM k JOIN v ON k.rest = v.word),
        p AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM k AS a JOIN k AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION ALL SELECT word, near, near_n FROM d
            UNION ALL SELECT near, word, n FROM d
        ),
        m AS (
            SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS best, max(near_n) AS best_n FROM p GROUP BY word
        ),
        f AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
                   CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
            FROM v LEFT JOIN m USING (word)
        ),
        e AS (
            SELECT word, form AS root FROM f WHERE form IS NOT NULL
            UNION ALL SELECT e.word, f.form FROM e JOIN f ON e.root = f.word WHERE f.form IS NOT NULL
        ),
        z AS (SELECT e.word, e.root FROM e JOIN f ON e.root = f.word WHERE f.form IS NULL)
        SELECT f.word, f.form, coalesce(z.root, f.word) AS root, f.n, f.n_near, f.form_n FROM f LEFT JOIN z ON f.word = z.word
    """,
}
