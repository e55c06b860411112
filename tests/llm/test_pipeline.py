import hashlib
import os

import pytest
from frames import documents, empty

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm import bpe, mixing, queries, secrets, simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_stages_and_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scans", "mixing", "bpe"]
    names = contract.queries()
    assert "pipeline" in names and [n.split("_")[0] for n in queries.catalog()] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not here")
def test_each_stage_against_brute_force(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    labels = queries.table(spark, SF_DIR, "labels")
    columns = docs.columns
    held = {r.doc_id: r for r in docs.collect()}
    scorer = toxicity.Scorer(toxicity.fit(docs, labels))
    kept = {i for i, r in held.items() if scorer.score(r.text) < 0.5}

    stage = dict(corpus_pipeline.STAGES)
    calm = stage["toxicity"](spark, docs, SF_DIR)
    assert calm.columns == columns and {r.doc_id for r in calm.collect()} == kept

    prints = {i: simhash.fingerprint(held[i].text, 3) for i in kept}
    groups = {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for i in kept:
            for j in kept:
                if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 2 and groups[j] < groups[i]:
                    groups[i], changed = groups[j], True
    single = {i for i, g in groups.items() if i == g}
    alone = stage["simhash_near_dedup"](spark, calm, SF_DIR)
    assert alone.columns == columns and {r.doc_id for r in alone.collect()} == single

    scan = secrets.Scanner(secrets.EntropyRule())
    clean = stage["secret_scans"](spark, alone, SF_DIR)
    texts = {i: secrets.redacted(held[i].text, scan.spans(held[i].text)) for i in single}
    assert clean.columns == columns and {r.doc_id: r.text for r in clean.collect()} == texts

    mixed = stage["mixing"](spark, clean, SF_DIR)
    place = {r.doc_id: r.position for r in mixing.mix(clean, queries.WEIGHTS).collect()}
    order = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == columns and order == sorted(single, key=place.get)

    last = {r.doc_id: r for r in stage["bpe"](spark, mixed, SF_DIR).collect()}
    with open(queries.VOCABULARY, encoding="utf-8") as file:
        coder = bpe.Codec(file.read())
    assert set(last) == single
    for i, row in last.items():
        assert row.ids_sha256 == hashlib.sha256(coder.encode(texts[i])).hexdigest()

    assert {tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {tuple(r) for r in last.values()}


def test_stages_keep_columns_of_awkward_tables(spark):
    for frame in (documents(spark, clashing=True), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, frame, SF_DIR)
            assert found.columns[:1] == ["doc_id"] if name == "bpe" else found.columns == frame.columns
            if name in ("secret_scans", "mixing", "bpe"):
                assert found.count() == frame.count()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not here")
def test_place_in_mixture_outlives_files(spark, tmp_path):
    docs = queries.table(spark, SF_DIR, "documents").repartition(7)
    docs.write.parquet(str(tmp_path / "mixed"))
    found = corpus_pipeline.as_tokens(spark, spark.read.parquet(str(tmp_path / "mixed")), SF_DIR)
    found.write.parquet(str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.doc_id: (r.slot, r.position) for r in rows} == {
        r.doc_id: (r.slot, r.position) for r in mixing.mix(docs, queries.WEIGHTS).collect()}
    assert len({r.position for r in rows}) == len(rows) == docs.count()
    last = corpus_pipeline.as_tokens(spark, documents(spark), SF_DIR).collect()
    assert len(last) == documents(spark).count() and {r.doc_id for r in last if r.position is None} == {None}


def test_near_copies_are_found_without_broadcasting_exploded_rows(spark, monkeypatch):
    frames, pairs = [], simhash.close_pairs
    monkeypatch.setattr(simhash, "close_pairs", lambda *given: frames.append(pairs(*given)) or frames[-1])
    corpus_pipeline.without_near_copies(spark, documents(spark), SF_DIR).collect()
    assert frames and all("Broadcast" not in f._jdf.queryExecution().executedPlan().toString() for f in frames)
