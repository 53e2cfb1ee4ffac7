"""The registered corpus queries, and the pipeline against its stages."""

import pytest
from check_queries import compare, connect
from conftest import SF_DIR

import corpus_pipeline
from riskweave.llm import jaccard, quality, toxicity
from riskweave.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_quality": {"doc_id", "score", "keep"},
    "op2_fingerprints": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op3_jaccard": {"doc_id", "class_id", "n_links", "component_id", "kept"},
    "op4_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op5_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op6_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op7_sentencepiece": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_embeddings": {"vec_id", "n_links", "component_id", "kept"},
    "op9_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op13_attention": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert COLUMNS[name] <= set(df.columns)
    source = {"op6_warc": "pages", "op8_embeddings": "embeddings"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()
    assert df.count() == rows if name != "op5_packing" else df.count() >= rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    verdict, rows = compare(spark, connect(SF_DIR), SF_DIR, name)
    assert verdict == "equal" and rows > 0


def test_pipeline_equals_its_decisions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit(toxicity.labelled(docs, labels, "toxic"))
    toxic = {r["doc_id"] for r in toxicity.with_scores(docs, model).filter("score >= 0.5").collect()}
    left = docs.filter(~docs["doc_id"].isin(list(toxic)) if toxic else "true")
    poor = {r["doc_id"] for r in quality.score(left, labels).filter("not keep").collect()}
    left = left.filter(~left["doc_id"].isin(list(poor)) if poor else "true")
    kept = {r["doc_id"] for r in jaccard.near_duplicates(left).filter("kept").collect()}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in got} == kept
    tokens = {}
    for r in got:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    assert all(tokens[r["doc_id"]] == r["doc_tokens"] for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]
