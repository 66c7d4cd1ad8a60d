"""Results on small tables against plain Python, the libraries, or exact round trips."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from raillark.llm import co_training, fingerprints, line_dedup, near_dedup, packing, pieces, quality_rules, token_counts, toxicity, viterbi, warc_zstd

DATA = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
PUNCT = re.compile("[\x20\x09-\x0d!-/:-@\\[-`{-~]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").toPandas()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_base_counts(spark, docs):
    got = by_id(quality_rules.op1_distribution_rules(spark, DATA))
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        words = WORD.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_distance_is_jensen_shannon():
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([[0.0, 0.5, 0.5]])
    assert quality_rules.distance(p, p)[0] == 0
    assert abs(quality_rules.distance(p, q)[0] - np.sqrt(0.5)) < 1e-12


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    hits = y.sum()
    return (rank[y == 1].sum() - hits * (hits + 1) / 2) / (hits * (len(y) - hits))


def test_classifiers_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    for query, target, least in ((toxicity.op2_conv_toxicity, "toxic", 0.9), (co_training.op4_co_training_quality, "quality", 0.95)):
        both = query(spark, folder).toPandas().merge(labels.dropna(subset=[target]), on="doc_id")
        held = both[both.held_out]
        assert auc(held.score.values, held[target].values.astype(int)) > least
        assert [bool(zlib.crc32(str(i).encode()) % 4 == 2) for i in both.doc_id] == both.held_out.tolist()


def test_line_join(spark, docs):
    lines = []
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        for k, line in enumerate(text.split("\n")):
            s = frozenset(w for w in PUNCT.split(lower(line)) if w)
            if s:
                lines.append((i, k, s))
    want = set()
    for b, (i, k, s) in enumerate(lines):
        if any(100 * len(s & t) >= 80 * len(s | t) for _, _, t in lines[:b]):
            want.add((i, k))
    gone, _ = line_dedup.removed_lines(spark.read.parquet(f"{DATA}/documents.parquet"))
    assert {(r.doc_id, r.line_no) for r in gone.collect()} == want


def test_line_join_in_long_lists(spark):
    """More near copies of one line than a list's cap; the exact way finds them all."""
    base = [f"tok{k}" for k in range(40)]
    rng = np.random.default_rng(1)
    rows = []
    for d in range(150):
        own = [w if rng.random() > 0.12 else f"x{d}{k}" for k, w in enumerate(base)]
        rows.append((d, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [set(t.split()) for _, t in rows]
    want = {b for b in range(150) if any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a in range(b))}
    gone, _ = line_dedup.removed_lines(df)
    assert {r.doc_id for r in gone.collect()} == want


def test_sketches(spark, docs):
    got = by_id(fingerprints.op5_scaled_sketch(spark, DATA))
    texts = docs.text.tolist()
    error = []
    for k, (i, text) in enumerate(zip(docs.doc_id, texts, strict=True)):
        n, nxt = len(text), texts[(k + 1) % len(texts)]
        edited = text[: n - n // 4] + nxt[: n // 4]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == n
        a, b = (({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()) for w in (WORD.findall(text), WORD.findall(edited)))
        if len(a) > 100:
            error.append(got[i].near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.12


def test_viterbi_against_library(docs):
    from sentencepiece import sentencepiece_model_pb2 as schema

    proto = schema.ModelProto()
    proto.ParseFromString(open(public_tokenizers.path(pieces.MODEL), "rb").read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = max(p.score, -40000)  # keeps the library's 32-bit sums exact
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    own = viterbi.lattice()
    for text in docs.text.tolist()[:100]:
        cut = own.model.segments(text)
        solved = viterbi.solve_all(sorted(set(cut)), own)
        assert [i for s in cut for i in np.frombuffer(solved[s], np.int32).tolist()] == library.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_pieces_round_trip_and_counts(text):
    own = viterbi.lattice()
    cut = own.model.segments(text)
    solved = viterbi.solve_all(sorted(set(cut)), own)
    ids = np.array([i for s in cut for i in np.frombuffer(solved[s], np.int32).tolist()], np.int32)
    assert viterbi.decode_ids(ids, own.model) == text.replace("▁", " ")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    assert sum(token_counts.merged_count(s, own.model) for s in cut) == len(library.encode(text))


def test_token_counts(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    got = by_id(token_counts.op8_token_counts(spark, DATA))
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        assert (got[i].n_tokens, got[i].n_bytes) == (len(library.encode(text)), len(text.encode()))


def components(sets, percent):
    above = list(range(len(sets)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for b in range(len(sets)):
        for a in range(b):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                p, q = sorted((top(a), top(b)))
                above[q] = p
    return [top(k) for k in range(len(sets))]


def shingles(text):
    w = WORD.findall(lower(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def test_near_components(spark, docs):
    want = components([shingles(t) for t in docs.text], 85)
    got = by_id(near_dedup.op7_minhash_near_dedup(spark, DATA))
    assert [got[i].component_id for i in docs.doc_id] == [docs.doc_id[k] for k in want]
    assert [got[i].n_shingles for i in docs.doc_id] == [len(shingles(t)) for t in docs.text]


@pytest.mark.parametrize("cells", [{"block": 16}, {"budget": 4000}])
def test_near_components_in_blocks(spark, cells):
    """A large group of near copies near the threshold, with lists split into blocks by their rows or their sets' sizes."""
    rng = np.random.default_rng(3)
    base = [f"t{k}" for k in range(300)]
    texts = [" ".join(w if rng.random() > 0.009 else f"z{d}" for w in base) for d in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(near_dedup.near_components(df, **cells))
    assert [got[k].component_id for k in range(120)] == components([shingles(t) for t in texts], 85)


def test_chunk_ids(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(packing.MODEL))
    own = packing.Chunks(public_tokenizers.path(packing.MODEL))
    odd = ["It's <|endoftext|> done...", "ΣΑΣ. İx É́ a.b,c!? 12.5, can't! don't.", "naïve — “x”", ". , !"]
    for text in [*docs.text.tolist(), *odd]:
        cut = text.split()
        own.learn(set(cut))
        got = np.frombuffer(b"".join(own.known[c] for c in cut), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(packing.MODEL))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in zip(docs.doc_id, docs.text, strict=True)}
    rows = packing.op9_best_fit_packing(spark, DATA).collect()
    used, got = Counter(), Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
        got[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert got == Counter({i: len(x) for i, x in ids.items()}) and max(used.values()) <= 4096
    assert len(used) <= -(-sum(got.values()) // 4096) + 1


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 40), max_size=30))
def test_plan_places_every_length(counts):
    plan = packing.Plan(dict(counts), 100, groups=4, large=20)
    placed = Counter()
    for times, used, lengths in plan.bins:
        assert used == sum(lengths) <= 100
        for n in lengths:
            placed[n] += times
    assert placed == Counter(counts)


def test_archives(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").toPandas()
    got = {r.page_id: r for r in warc_zstd.op10_warc_zstd(spark, DATA).collect()}
    for i, html in zip(pages.page_id, pages.html, strict=True):
        body = html.encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(body), hashlib.sha1(body).hexdigest())


def test_archive_frames(tmp_path):
    import io

    from pyarrow import fs

    records = [warc_zstd.record(k, f"http://x/{k}", f"<p>page {k} of the same site</p>".encode() * 9, "d", 1, "response", None) for k in range(200)]
    path = str(tmp_path / "a.warc.zst")
    warc_zstd.write_file(fs.LocalFileSystem(), path, iter(records))
    raw = open(path, "rb").read()
    assert int.from_bytes(raw[:4], "little") == warc_zstd.MAGIC
    assert list(warc_zstd.read_file(io.BytesIO(raw))) == records
