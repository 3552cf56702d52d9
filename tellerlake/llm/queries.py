"""Registered queries of the subpackage: each applies its operator to a whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm import bpe, chat, codes, decontaminate, lbl, licenses, mil, rules, secret_scan, shards, simhash, warc, whiten
from tellerlake.operators.joins import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")

    def of(*kinds):
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS]
    return secret_scan.scan(docs).select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.joined(of(*secret_scan.BASE_KINDS)), 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"),
    )


def bpe_digest(n: int, ids: str, decoded: str) -> dict:
    return {
        "n_tokens": n,
        "ids_sha256": hashlib.sha256(ids.encode()).hexdigest(),
        "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
    }


BPE_FIELDS = "n_tokens:bigint,ids_sha256:string,decoded_sha256:string"


def word_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, word_vocabulary(), finish=bpe_digest, fields=BPE_FIELDS).select("doc_id", "bpe.*")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = F.col("hits")
    return decontaminate.find(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        F.size(hits["words"]).cast("long").alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(hits["items"]), ","), 256).alias("items_sha256"),
        decontaminate.contaminated(hits).alias("contaminated"),
    )


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return placed.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


CHECK_SQL["op8_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, text, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item_id, size, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM sized)),
sizes AS (SELECT DISTINCT size FROM grams),
windows AS (
  SELECT rid, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT rid, size, k, item_id FROM windows JOIN grams USING (size, gram)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + size)) AS p FROM found) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY rid)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""


def fold(column: str, folds: int):
    """crc32 of the column as text, modulo ``folds``; null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


QUALITY_CUT = 0.7


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    scored = mil.score(docs, mil.train(docs, labels))
    return scored.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


@query
def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lbl.score(docs, fold("doc_id", 5) == 1)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


CONTROL = "</s>[INST] ok [/INST]"


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    # All columns go there: the fingerprint says where the turns are.
    rows = rows.unionByName(added, allowMissingColumns=True)
    read = chat.format_rows(rows).withColumn("turns", chat.read_back(F.col("formatted")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat.loss_texts(F.col("turns")), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CHECK_SQL["op6_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(8 + length(role) + length(regexp_replace(role, '[^\\\[<\n]', '', 'g'))
                  + length(text) + length(regexp_replace(text, '[^\\\[<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.sort_array(F.concat(*[F.col(f"base.`{label}`") for label in licenses.BASE]))
    labels = F.array_compact(F.array(*[F.when(F.size(F.col(f"base.`{label}`")) > 0, F.lit(label)) for label in licenses.BASE]))
    return found.withColumns({"places": places, "base_labels": labels}).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.get("places", F.lit(0)).cast("long").alias("first_word"),
        F.get("places", F.size("places") - 1).cast("long").alias("last_word"),
        F.array_join(F.sort_array("base_labels"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base_labels", "notices")), ",").alias("labels"),
        "score",
    )


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_pages(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


CHECK_SQL["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS response FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM f
"""


@query
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"), carry=["label"])
    coded = written(coded, "codes")
    by_label = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    same = F.col("label").eqNullSafe(F.col("of")) & (F.xxhash64("label") == F.xxhash64("of"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(by_label, same).select(
        "vec_id",
        F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = [
        f"""
nearest{r} AS (
  SELECT rid, p, CAST(least_at % {entries} AS INTEGER) AS k, least_at // {entries} AS far
  FROM (SELECT rid, p, min(CAST(list_inner_product(v, v) - 2 * list_inner_product(v, e) + list_inner_product(e, e) AS BIGINT)
                           * {entries} + k) AS least_at
        FROM parts JOIN books{r} USING (p) GROUP BY rid, p))"""
        + (
            f""",
cells{r} AS (
  SELECT p, k, pos, CAST(floor(CAST(sum(CAST(c AS BIGINT)) AS BIGINT) / count(*)) AS DOUBLE) AS c
  FROM (SELECT p, k, unnest(v) AS c, generate_subscripts(v, 1) AS pos FROM parts JOIN nearest{r} USING (rid, p)) GROUP BY ALL),
books{r + 1} AS (
  SELECT p, k, coalesce(m, e) AS e
  FROM books{r} LEFT JOIN (SELECT p, k, list(c ORDER BY pos) AS m FROM cells{r} GROUP BY p, k) USING (p, k))"""
            if r < rounds
            else ""
        )
        for r in range(rounds + 1)
    ]
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS rid, x, len(x) // {parts} AS w
  FROM (SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
parts AS (SELECT rid, p, x[p * w + 1 : (p + 1) * w] AS v FROM kept, (SELECT unnest(range({parts})) AS p)),
books0 AS (SELECT p, rid AS k, v AS e FROM parts WHERE rid < {entries}),{",".join(steps)},
shown AS (
  SELECT rid, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM nearest{rounds} GROUP BY rid),
books AS (
  SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, pos)) AS codebooks_sha256
  FROM (SELECT p, k, unnest(e) AS c, generate_subscripts(e, 1) AS pos FROM books{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN shown USING (rid), books
"""


CHECK_SQL["op11_codes"] = _codes_sql()


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fitted = whiten.whiten(table(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(float(x)) for x in fitted.explained]) if len(fitted.values) else F.array().cast("array<double>")
    return rows.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(fitted.identity_error).alias("identity_error"),
    )


@query
def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    written_shards = shards.shuffle(table(spark, sf_dir, "documents"))
    return written_shards.select(
        F.col("record.doc_id").alias("doc_id"),
        "size",
        F.col("checksum").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
