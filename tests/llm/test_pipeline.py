import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    seen = {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.count()
        assert at == 4 or docs.columns == columns
    assert list(seen) == ["quality_classifier", "simhash_dedup", "secret_scan", "source_mix", "piece_codec"]
    assert n > seen["quality_classifier"] > seen["simhash_dedup"] == seen["secret_scan"] and seen["source_mix"] == seen["piece_codec"] > 0


def test_stages_bear_odd_rows(spark, tmp_path):
    """Null and shared ids, null texts, repeats, clashing columns; against each stage's own rule."""
    import hashlib

    import sentencepiece
    from paperloom.llm import queries, simhash_dedup
    from tests.llm.cases import docs as made
    from tests.llm.cases import odd_docs, prose

    clash = ("_n", "_id", "_stay", "_text_hash", "lm_block", "lm_own", "lm_lang", "mix_u", "copies", "size", "fp", "component_id", "ids", "findings")
    rows = odd_docs() + [(None, prose(i, 60), "en", "a", 0) for i in range(30, 42)] + [(5, prose(i, 60) + f' token = "{"0123456789abcdef" * 2}"', "en", "b", 0) for i in range(50, 54)]
    now = made(spark, rows, clash=clash)
    columns, before = now.columns, now.collect()
    # Nobody is trusted, so that the first stage keeps everything for the others.
    spark.createDataFrame([(1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        got = now.collect()
        if at < 4:
            assert now.columns == columns
        if name == "quality_classifier":
            assert len(got) == len(rows)
        if name == "simhash_dedup":
            prints = {r.fingerprint for r in simhash_dedup.near_duplicates(made(spark, [(i, r.text, None, None, None) for i, r in enumerate(before)])).collect()}
            assert 10 < len(got) <= len(prints) and len({r.text for r in got}) == len(got)
        if name == "secret_scan":
            assert len(got) == len(before) and not any("0123456789abcdef" in (r.text or "") for r in got)
            assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
        if name == "piece_codec":
            library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model_path())
            want = sorted(hashlib.sha256(",".join(map(str, library.encode(r.text or ""))).encode()).hexdigest() for r in before)
            assert sorted(r.ids_sha256 for r in got) == want
        before = got


def test_stages_bear_empty_tables(spark, tmp_path):
    from tests.llm.cases import no_docs

    for name, stage in corpus_pipeline.STAGES:
        no_docs(spark).write.mode("overwrite").parquet(str(tmp_path / "in"))
        assert stage(spark, spark.read.parquet(str(tmp_path / "in")), SF).collect() == [], name
