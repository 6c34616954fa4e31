"""The pipeline against plain versions of its stages, one stage at a time."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from tests_paths import SF0001
from pyspark.sql import functions as F

from spanpack.llm import decontam, queries, suffixes


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows over the small tables."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF0001}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF0001)
        assert k == len(corpus_pipeline.STAGES) - 1 or made.columns == docs.columns
        made.write.parquet(str(folder / name))
        after = spark.read.parquet(str(folder / name))
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def test_stages_against_plain_versions(spark, stages):
    before, after = stages[0]
    scored = {r["doc_id"]: r["predicted"] for r in queries.op4_toxicity(spark, SF0001).collect()}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if not scored[r["doc_id"]]}

    before, after = stages[1]
    ids = [r["doc_id"] for r in before]
    groups = brute.components(ids, [brute.simhash(r["text"]) for r in before])
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r, g in zip(before, groups) if r["doc_id"] == g)

    before, after = stages[2]
    texts = {r["doc_id"]: r["text"] for r in after}
    for r, (n, gone, _, _) in zip(before, brute.cut([r["text"] for r in before], corpus_pipeline.PASSAGE_BYTES)):
        assert n - gone <= len(texts[r["doc_id"]].encode()) <= n - gone + 6 * (gone > 0)
        assert gone or texts[r["doc_id"]] == r["text"]

    before, after = stages[3]
    items = [r["text"] for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    index = decontam.Items(list(enumerate(items)))
    leaky = {r["doc_id"] for r, found in zip(before, index.leaks([r["text"] for r in before])) if found}
    assert {r["doc_id"] for r in before if any(i in r["text"] for i in items)} <= leaky
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - leaky

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    before, after = stages[4]
    assert {r["doc_id"]: (r["ids"], r["decoded"]) for r in after} == {r["doc_id"]: (sp.encode(r["text"]), sp.decode(sp.encode(r["text"]))) for r in before}


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF0001).collect())) == sorted(map(tuple, stages[-1][1]))


def test_stages_on_edge_rows(spark, tmp_path, wide_docs, no_docs):
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF0001}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    wide_docs.write.parquet(str(tmp_path / "documents.parquet"))
    for docs in (wide_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, str(tmp_path))
            assert name == "sentencepiece" or made.columns == docs.columns
            made.write.parquet(str(tmp_path / f"{name}-{docs is no_docs}"))


def test_registered_queries_on_given_tables(spark):
    """Ids and digests of the whole small tables, against plain versions."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    cut = {i: w for i, w in zip(docs, brute.cut(list(docs.values()), 400))}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op10_suffix_dedup(spark, SF0001).collect()}
    assert got == cut and any(w[1] for w in cut.values())
    edited = brute.edited(list(docs.items()))
    for r in queries.op3_fingerprints(spark, SF0001).collect():
        text, (new, after) = docs[r["doc_id"]], edited[r["doc_id"]]
        a, b, c = (brute.sketch(t) for t in (text, new, after))
        told = "".join(f"{x % 2**64:016x}" for x in a), "".join(f"{x % 2**64:016x}" for x in b)
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), brute.sha(new.encode()), *told)
        assert abs(r["near_edited"] - brute.resemblance(a, b)) < 1e-12 and abs(r["near_next"] - brute.resemblance(a, c)) < 1e-12
    pairs = {(i, r["item_id"]) for i, t in docs.items() for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect() if r["text"] in t}
    assert pairs <= {(r["doc_id"], r["item_id"]) for r in queries.op6_decontamination(spark, SF0001).collect()}


def test_whole_characters():
    raw = "aé😀b".encode()
    for a in range(len(raw) + 1):
        for b in range(a, len(raw) + 1):
            kept = suffixes.without(raw, suffixes.whole_characters(raw, [(a, b)]))
            kept.decode()
            assert len(kept) >= len(raw) - (b - a)


def test_unsettled_folder_is_never_local_on_a_cluster(spark):
    from spanpack.llm.common import shared_folder

    assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()
    assert spark.range(3).agg(F.sum("id")).first()[0] == 3
