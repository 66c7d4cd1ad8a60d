"""Every operator gives each edge row a defined result and takes an empty table."""

import io

import pytest
from pyarrow import fs

from raillark.llm import co_training, fingerprints, line_dedup, near_dedup, packing, quality_rules, token_counts, toxicity, viterbi, warc_zstd

IDS = sorted([1, 2, 2, 3, 4, 5, 6, 7, -9, 1000])  # 1000 stands for null


def ids(df, name="doc_id"):
    return sorted(1000 if r[name] is None else r[name] for r in df.select(name).collect())


def test_quality(edge_docs, no_docs):
    rows = {r.doc_id: r for r in quality_rules.judged(edge_docs).collect()}
    assert rows[3].n_words == 0 and rows[3].base_failed and not rows[3].kept
    assert rows[1].n_dup_lines == 5 and rows[1].n_repeat_words == 72 and rows[1].base_failed
    assert rows[5].n_words == 30000 and not rows[5].base_failed
    assert ids(quality_rules.judged(edge_docs)) == IDS
    assert quality_rules.judged(no_docs).count() == 0
    assert quality_rules.kept_rows(edge_docs).columns == edge_docs.columns


def test_toxicity(edge_docs, no_docs, labels):
    model = toxicity.fit(edge_docs, labels)
    out = toxicity.scored(edge_docs, model)
    assert ids(out) == IDS and all(0 <= r.score <= 1 for r in out.collect())
    assert toxicity.fit(no_docs, labels) is None
    assert toxicity.scored(no_docs, None).count() == 0
    assert all(r.score == 0 for r in toxicity.scored(edge_docs, None).collect())
    assert toxicity.clean_rows(edge_docs, labels).columns == edge_docs.columns


def test_lines(edge_docs, no_docs):
    gone, _ = line_dedup.removed_lines(edge_docs)
    got = {(r.doc_id, r.line_no) for r in gone.collect()}
    assert {(1, k) for k in range(1, 6)} | {(2, k) for k in range(6)} == got
    kept = line_dedup.cleaned(edge_docs)
    assert kept.columns == edge_docs.columns
    assert ids(kept) == sorted([1, 3, 4, 5, 6, 7, -9, 1000])
    assert line_dedup.cleaned(no_docs).count() == 0


def test_co_training(edge_docs, no_docs, labels):
    out = co_training.scored(edge_docs, co_training.fit(edge_docs, labels))
    assert ids(out) == IDS
    assert co_training.fit(no_docs, labels) is None
    assert co_training.scored(no_docs, None).count() == 0


def test_fingerprints(edge_docs, no_docs):
    rows = fingerprints.edited_pairs(edge_docs).collect()
    assert sorted(1000 if r.doc_id is None else r.doc_id for r in rows) == IDS
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1.0
    assert by[3].n_chars == 0 and by[3].fingerprint == by[4].fingerprint
    assert fingerprints.edited_pairs(no_docs).count() == 0


def test_pieces(edge_docs, no_docs):
    rows = {r.doc_id: r for r in viterbi.decode(viterbi.encode(edge_docs)).collect()}
    assert rows[5].decoded == rows[5].text and rows[3].decoded == "" and rows[3].n_tokens == 0
    assert rows[7].decoded == rows[7].text.replace("▁", " ")
    assert viterbi.decode(viterbi.encode(no_docs)).count() == 0


def test_near(edge_docs, no_docs):
    rows = near_dedup.near_components(edge_docs).collect()
    assert sorted(1000 if r.doc_id is None else r.doc_id for r in rows) == IDS
    by = {r.doc_id: r for r in rows}
    assert by[2].component_id == 1 and not by[2].kept and by[None].component_id == 1
    assert by[3].kept and by[4].kept and by[6].n_shingles == 0 and by[-9].n_shingles == 1
    assert near_dedup.near_components(no_docs).count() == 0


def test_counts(edge_docs, no_docs):
    rows = {r.doc_id: r for r in token_counts.count_tokens(edge_docs).collect()}
    assert rows[3].n_tokens == 0 and rows[5].over_limit
    assert token_counts.count_tokens(no_docs).count() == 0


def test_packing(edge_docs, no_docs):
    rows = packing.packed(edge_docs).collect()
    assert sorted({1000 if r.doc_id is None else r.doc_id for r in rows}) == sorted(set(IDS))
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096
    assert packing.packed(no_docs).count() == 0


def test_archives(spark, tmp_path):
    big, other = "x" * 1500, "y" * 999
    rows = [(1, "http://a/\n1", big), (2, None, big), (3, "u", None), (4, "u", other), (5, "u", other), (None, "u", big), (2, None, big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as payload")
    folder = f"file://{tmp_path}/w"
    assert warc_zstd.write_archives(pages, folder).groupBy().sum("n_records").collect()[0][0] == 7
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc_zstd.read_archives(spark, folder).collect())
    assert got == [(0, "response", None, 1500), (1, "revisit", 2, 1500), (2, "response", None, 1500), (2, "response", None, 1500), (3, "response", None, 0), (4, "response", None, 999), (5, "response", None, 999)]
    empty = f"file://{tmp_path}/e"
    assert warc_zstd.write_archives(pages.where("false"), empty).count() == 0
    assert warc_zstd.read_archives(spark, empty).count() == 0


@pytest.mark.parametrize("n", [1, 3, 200])
def test_one_archive(tmp_path, n):
    """Every archive begins with a dictionary; one that was cut is an error."""
    store, path = fs.LocalFileSystem(), f"{tmp_path}/a.warc.zst"
    records = [warc_zstd.record(k, f"http://host/{k}", f"<p>page {k} of the same site</p>".encode() * 9, "0" * 40, 5, "response", None) for k in range(n)]
    assert warc_zstd.write_file(store, path, iter(records)) == n
    raw = open(path, "rb").read()
    assert int.from_bytes(raw[:4], "little") == warc_zstd.MAGIC
    assert list(warc_zstd.read_file(io.BytesIO(raw))) == records
    for cut in (len(raw) - 7, len(raw) - 1, 12, 5):
        with pytest.raises(ValueError, match="archive"):
            list(warc_zstd.read_file(io.BytesIO(raw[:cut])))


def test_archive_of_no_records(tmp_path):
    with pytest.raises(ValueError, match="record"):
        warc_zstd.write_file(fs.LocalFileSystem(), f"{tmp_path}/none", iter([]))


@pytest.mark.parametrize("name", ["quality", "toxic", "lines", "near"])
def test_pipeline_stage_keeps_columns(spark, edge_docs, no_docs, name):
    import corpus_pipeline

    stage = getattr(corpus_pipeline, name)
    for docs in (edge_docs, no_docs):
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == edge_docs.columns


def test_whole_pipeline(spark, edge_docs, no_docs, labels, tmp_path):
    """Clashing columns and an empty table go through all stages; what comes out is packed pieces of kept documents."""
    import corpus_pipeline

    good = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, docs in (("edges", edge_docs), ("none", no_docs), ("plain", good)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet") if name == "plain" else labels
        known.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    corpus_pipeline.run(spark, f"{tmp_path}/edges").collect()
    rows = corpus_pipeline.run(spark, f"{tmp_path}/plain").collect()
    judged = {r.doc_id for r in quality_rules.judged(good).where("kept").collect()}
    assert rows and {r.doc_id for r in rows} <= judged
