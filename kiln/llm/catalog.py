"""Queries of the training-data operators on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (alignment, decontaminate, filter_audit, hilbert, idfiles, mainbody, maxscore, neighbours, packing,
               simhash, substrings, toxicity, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(_table(spark, sf_dir, "documents")))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model).drop("text")
            .withColumn("held_out", toxicity.held_out("doc_id"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainbody.extract_text(_table(spark, sf_dir, "pages"))


def op5_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = idfiles.through_files(_table(spark, sf_dir, "documents"))
    return back.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.through_archives(_table(spark, sf_dir, "pages"))


def op8_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(_table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"),
                                      _table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.text_failures(_table(spark, sf_dir, "documents"))
    marked = filter_audit.with_labels(rows, _table(spark, sf_dir, "labels"))
    return filter_audit.interactions(marked, "ABCDE", n="n", weights=["good", "toxic"])


def op12_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.quantised(_table(spark, sf_dir, "embeddings"))
    return maxscore.search(vectors, vectors.where("id % 100 = 0"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_substrings": op2_substrings,
    "op3_toxicity": op3_toxicity,
    "op4_main_text": op4_main_text,
    "op5_id_files": op5_id_files,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_hilbert": op8_hilbert,
    "op9_neighbours": op9_neighbours,
    "op10_decontaminate": op10_decontaminate,
    "op11_filter_audit": op11_filter_audit,
    "op12_maxscore": op12_maxscore,
    "op13_alignment": op13_alignment,
}

#: DuckDB SQL where SQL can express the result
ORACLES: dict[str, str] = {
    "op2_substrings": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
           FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS k
        FROM w, unnest(range(1, len(ws) - 18)) t(p)),
again AS (SELECT doc_id, p FROM win
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, i FROM again, unnest(range(p, p + 20)) t(i)),
word AS (SELECT doc_id, i, ws[i] AS x FROM w, unnest(range(1, len(ws) + 1)) t(i)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t
         FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op7_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)""",
    "op9_neighbours": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
       AS rank, vec_id, score
FROM s QUALIFY rank <= 20""",
    "op11_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 END), 0) AS good,
             coalesce(max(CASE WHEN toxic = 1 THEN 1 END), 0) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
                    100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x),
                    regexp_matches(x, '[#$%&*|]'),
                    coalesce(min(doc_id) OVER (PARTITION BY x) < doc_id, false)] AS f,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM t LEFT JOIN l USING (doc_id)),
c AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, f),
i AS (SELECT unnest(range(1, 6)) AS k),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM i a, i b, i c, i d, i e
      WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT part, o, i.k AS step, o[i.k] AS g, f[o[i.k]] AS fails, n, good, toxic,
             len(list_filter(f, lambda x: x)) = 1 AS alone,
             len(list_filter(o[1:i.k - 1], lambda y: f[y])) > 0 AS gone FROM c, o, i),
r AS (SELECT part, o, step, g, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails AND alone THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
      FROM s GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, g) AS BIGINT) AS shapley FROM r""",
    "op12_maxscore": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
       AS rank, vec_id, score
FROM s QUALIFY rank <= 10""",
}
