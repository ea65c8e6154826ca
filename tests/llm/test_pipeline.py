"""The corpus pipeline: each stage against its operator, and the whole against plain Python at the smallest scale."""

import corpus_pipeline as pipeline

from tessera.llm import packing, quality, secret_scan

from .test_llm import SF, brute_components


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r["doc_id"] for r in quality.quality_digests(docs).where("kept").collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = [i for i, (_, c) in brute_components([(i, text[i]) for i in good]).items() if i == c]
    machine = secret_scan.build_automaton()
    now, seen = docs, []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        made = stage(spark, now, SF)
        assert k == len(pipeline.STAGES) - 1 or made.columns == docs.columns
        made.write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(now)
    assert {r["doc_id"] for r in seen[0].collect()} == good
    assert sorted(r["doc_id"] for r in seen[1].collect()) == sorted(left)
    assert sorted(r["doc_id"] for r in seen[3].collect()) == sorted(left)
    assert not any(secret_scan.scan_text(r["text"], machine) for r in seen[2].collect())
    pieces = seen[4].collect()
    assert {r["doc_id"] for r in pieces} == set(left)
    # Sequences of one length follow the order of the mix, as the files of its stage hold it.
    place = {r["doc_id"]: (r["f"], r["i"]) for r in seen[3].selectExpr("doc_id", "_metadata.file_name f", "_metadata.row_index i").collect()}
    for size in {r["length"] for r in pieces}:
        own = sorted((r for r in pieces if r["length"] == size), key=lambda r: r["sequence_id"])
        assert [place[r["doc_id"]] for r in own] == sorted(place[r["doc_id"]] for r in own)
    total = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert all(sum(r["length"] for r in pieces if r["doc_id"] == i) == n for i, n in total.items())
    assert all(packing.pieces_of(n)[0] == max(r["length"] for r in pieces if r["doc_id"] == i) for i, n in total.items())


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
