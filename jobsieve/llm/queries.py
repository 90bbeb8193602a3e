"""One query per operator with production parameters, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import contaminated
from . import ann, chat, codes, filters, language, licenses, lm, pieces, quality
from .near_dedup import near_duplicates
from .packing import best_fit_pack
from .store import table
from .warc import archive_pages

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Words of the language model's n-grams.
LM_ORDER = 3


def op6_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(ann.build_index(vectors), vectors.where(F.col("vec_id") % 50 == 0))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_pages(table(spark, sf_dir, "pages"))
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 of doc_id as text, for the splits of the contracts.
def _crc(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(F.coalesce(_crc(4), F.lit(0)) != 2), BYTE_RANKS)
    found = docs.select("doc_id", F.coalesce(_crc(4) == 2, F.lit(False)).alias("held_out"), language.identify(F.col("text"), model, spark).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_crc(10) == 0, F.lit(False))
    model = lm.fit(docs.where(~held), order=LM_ORDER)
    found = lm.score(docs, model, extra={"held_out": held})
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(_crc(5) != 0)
    model = quality.fit(docs, labels)
    found = docs.select("doc_id", F.coalesce(_crc(5) == 0, F.lit(False)).alias("held_out"), quality.quality(F.col("text"), model, spark).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.codes(table(spark, sf_dir, "embeddings")).drop("label")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), PIECE_BPE), PIECE_BPE)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


OP1_SQL = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda x: x <> '') AS ws FROM t),
i AS (SELECT id AS item_id, least(len(ws), 5) AS k, ws FROM w WHERE kind = 'i' AND len(ws) > 0),
g AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda j: array_to_string(ws[j:j + k - 1], ' '))) AS g FROM i),
s AS (SELECT DISTINCT id AS doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda j: array_to_string(ws[j:j + k - 1], ' '))) AS g
      FROM w, (SELECT DISTINCT k FROM i) WHERE kind = 'd' AND len(ws) >= k),
n AS (SELECT item_id, count(*)::BIGINT AS n_item FROM g GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*)::BIGINT AS n_shared FROM s JOIN g USING (k, g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item::DOUBLE AS containment FROM c JOIN n USING (item_id) WHERE n_shared >= 0.75 * n_item"""


#: Bare base32 of the SHA-1: each five hexadecimal digits are four letters.
_BASE32 = """list_aggregate(flatten(list_transform(range(0, 8), lambda g: list_transform([32768, 1024, 32, 1], lambda u:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1(body), 5 * g::BIGINT + 1, 5))::BIGINT // u) % 32)::BIGINT + 1, 1)))), 'string_agg', '')"""

OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
             min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""


#: Each document's failures, then every order step by step: no subsets, no transform.
OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[ 	-]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
f AS (SELECT doc_id, part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN len(ws) < 50 WHEN 'B' THEN 100 * len(list_distinct(ws)) < 65 * len(ws)
        WHEN 'C' THEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) WHEN 'D' THEN regexp_matches(text, '[#$%&*|]') ELSE doc_id > first_id END) AS fails,
        coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic FROM w LEFT JOIN labels USING (doc_id)),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT part, filter_order, fails, good, toxic, count(*) AS n, coalesce(list_min(list_transform(fails, lambda x: instr(filter_order, x))), 6) AS gone FROM f, o GROUP BY ALL),
r AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS own,
        sum(CASE WHEN gone > step THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN gone < step AND list_contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails = [substr(filter_order, step, 1)] THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN gone = step AND good THEN n ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN gone = step AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
      FROM s, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""


def _op12_sql() -> str:
    """Lloyd's rounds over all distances."""

    def near(name: str, book: str) -> str:
        d = "list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return f"{name} AS (SELECT row, p, any_value(q) AS q, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (SELECT row, p, q, e, {d} AS d FROM parts JOIN {book} USING (p)) GROUP BY row, p)"

    def book(name: str, old: str, near: str) -> str:
        return f"""{name}_s AS (SELECT p, e, i, floor(sum(x) / count(*)::DOUBLE)::BIGINT AS x FROM (SELECT p, e, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM {near}) GROUP BY p, e, i),
        {name}_l AS (SELECT p, e, list(x ORDER BY i) AS c FROM {name}_s GROUP BY p, e),
        {name} AS (SELECT p, e, coalesce(n.c, o.c) AS c FROM {old} o LEFT JOIN {name}_l n USING (p, e))"""

    return f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row
        FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (SELECT row, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS q FROM kept, (SELECT unnest(range(16)) AS p)),
    b0 AS (SELECT p, row - 1 AS e, q AS c FROM parts WHERE row <= 64),
    {near("n0", "b0")}, {book("b1", "b0", "n0")}, {near("n1", "b1")}, {book("b2", "b1", "n1")}, {near("n2", "b2")},
    k AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM b2)),
    r AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n2 GROUP BY row)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN r USING (row), k"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_language_id": op2_language_id,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_arc_to_warc": op5_arc_to_warc,
    "op6_ann_search": op6_ann_search,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_chat_repair": op8_chat_repair,
    "op9_license_scan": op9_license_scan,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_vector_codes": op12_vector_codes,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_SQL: dict[str, str] = {
    "op1_benchmark_decontamination": OP1_SQL,
    "op10_minhash_near_dedup": OP10_SQL,
    "op5_arc_to_warc": OP5_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_vector_codes": _op12_sql(),
}
