import hashlib

import __spark_entry__ as entry
import corpus_pipeline
from pyspark.sql import functions as F
from tellerlake.llm import bpe, mil, queries, secret_scan
from test_decontaminate import brute as brute_hits
from test_simhash import brute_classes, brute_fingerprint

SF = "/root/testdata/sf0.001"


def kept_by_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(queries.fold("doc_id", 4) != 2)
    model = mil.train(docs, labels)
    return [r for r in docs.orderBy("doc_id").collect() if model.score([mil.passages((r.text or "").encode())])[0] >= 0.7]


def test_stages_take_effect_and_equal_brute_force(spark):
    rows = kept_by_quality(spark)
    assert 0 < len(rows) < spark.read.parquet(f"{SF}/documents.parquet").count()
    label = brute_classes([brute_fingerprint(r.text) for r in rows])
    rows = [r for k, r in enumerate(rows) if label[k] == k]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = brute_hits([r.text for r in rows], items)
    rows = [r for r, (n, at, _) in zip(rows, hits) if not (at and 20 * len(at) >= n)]
    keywords, tokenizer, want = secret_scan.automaton(), bpe.load(queries.word_vocabulary()), {}
    for r in rows:
        text, end, parts = r.text, 0, []
        for _, a, b in secret_scan.spans_of(text, keywords):
            if b > end:
                parts += [text[end : max(a, end)], "[redacted]" if a >= end else ""]
                end = b
        text = "".join(parts) + text[end:]
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in entry.queries()["pipeline"](spark, SF).collect()}
    assert got == want


def test_each_stage_keeps_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", "s", 0), (-5, "", "en", "s", 0)], docs.schema)
    docs = docs.limit(40).union(extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    assert corpus_pipeline.secrets(spark, docs, SF).where(F.col("n_chars") != F.length("text")).count() == 0
