"""The stages of the pipeline on a small corpus, against what brute force keeps."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import corpus
import corpus_pipeline
from plinth.llm import batches, bpe, decontaminate, language_id, simhash, suffix_dedup
from test_text_operators import _brute_hits, brute_components, brute_fingerprint, brute_repeats

DOCS = corpus.rows()
EXTRA = {"_language": "a", "_kept": "b", "_hits": "c", "fp": "d", "_kept_id": "e"}


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    return corpus.write(tmp_path_factory.mktemp("sf"), DOCS, EXTRA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def test_language_stage_keeps_whole_rows(spark, docs, sf):
    kept = language_id.stage_language(spark, docs, sf)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    none = {d["doc_id"] for d in DOCS if not any(c.isalpha() for c in d["text"] or "")}
    assert not ids & (none - {None})
    assert len({d["doc_id"] for d in DOCS if d["doc_id"] is not None and d["doc_id"] < 70} - ids) <= 2


def test_near_dedup_stage_keeps_one_of_each_group(spark, docs, sf):
    kept = simhash.stage_near_dedup(spark, docs, sf)
    assert kept.columns == docs.columns
    groups = defaultdict(list)
    for d, c in zip(DOCS, brute_components([brute_fingerprint(d["text"]) for d in DOCS])):
        groups[c].append((d["doc_id"] is None, d["doc_id"] or 0, d["text"]))
    first = [min(g, key=lambda x: x[:2]) for g in groups.values()]
    want = Counter(None if none else i for none, i, _ in first)
    assert {r["doc_id"] for r in kept.collect()} == set(want)
    # the repeated row is the same document, of which one row stays
    assert Counter(r["doc_id"] for r in kept.collect())[5] == 1


def test_near_dedup_leaves_no_repeats_for_the_suffix_stage(spark, tmp_path):
    rng = random.Random(5)
    twice, nameless = corpus.prose(rng, "en", 90), corpus.prose(rng, "de", 90)
    some = [dict(d) for d in DOCS if (d["doc_id"] or 99) < 60]
    some += [{"doc_id": 900, "text": twice, "lang": "en", "source": "s", "n_chars": len(twice)}] * 3
    some += [{"doc_id": None, "text": nameless, "lang": "de", "source": s, "n_chars": None} for s in ("b", "a", None, "a")]
    docs = spark.read.parquet(corpus.write(tmp_path, some) + "/documents.parquet").repartition(3)
    kept = simhash.stage_near_dedup(spark, docs, str(tmp_path))
    assert kept.schema == docs.schema
    groups = defaultdict(list)
    for d, c in zip(some, brute_components([brute_fingerprint(d["text"]) for d in some])):
        groups[c].append((d["doc_id"] is None, d["doc_id"] or 0, d["text"] or ""))
    want = Counter((None if none else i, text) for none, i, text in map(min, groups.values()))
    rows = kept.collect()
    assert Counter((r["doc_id"], r["text"] or "") for r in rows) == want
    assert [r["source"] for r in rows if r["doc_id"] is None] == [None]
    texts = [(r["text"] or "").encode() for r in rows]
    left = Counter()
    for r, t, hit in zip(rows, texts, brute_repeats(texts, 200)):
        left[r["doc_id"], bytes(b for b, h in zip(t, hit) if not h).decode("utf-8", "ignore")] += 1
    cut = suffix_dedup.stage_suffix_dedup(spark, spark.createDataFrame(rows, kept.schema), str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["text"] or "") for r in cut) == left
    assert all(r["text"] for r in cut if r["doc_id"] in (5, 900, None))


def test_suffix_stage_takes_the_bytes_out(spark, docs, sf):
    kept = suffix_dedup.stage_suffix_dedup(spark, docs, sf)
    assert kept.columns == docs.columns and kept.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    texts = [(d["text"] or "").encode() for d in DOCS]
    want = Counter()
    for d, t, hit in zip(DOCS, texts, brute_repeats(texts, 200)):
        left = bytes(b for b, h in zip(t, hit) if not h).decode("utf-8", "ignore")
        want[(d["doc_id"], left, len(left) if hit.any() else d["n_chars"])] += 1
    assert Counter((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()) == want


def test_decontamination_stage_drops_what_is_contaminated(spark, docs, sf):
    kept = decontaminate.stage_decontaminate(spark, docs, sf)
    assert kept.columns == docs.columns
    want = Counter(h[0] for h in _brute_hits(corpus.benchmark(DOCS)) if not h[5])
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_stages(spark, sf, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "suffix_dedup", "decontamination", "bpe"]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert 20 < len(rows) < len(DOCS)
    # every stage alone on the one before, as run() does
    now = docs
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in now.collect()) == Counter((r["doc_id"], r["ids_sha256"]) for r in rows)


def test_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, corpus.write(tmp_path, [])).collect() == []


def test_near_dedup_groups_no_texts_but_those_of_repeated_rows(spark, tmp_path_factory, monkeypatch):
    rng = random.Random(7)
    some = [{"doc_id": k, "text": corpus.prose(rng, "en", 40), "lang": "en", "source": "s", "n_chars": k} for k in range(8)]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    single = spark.read.parquet(corpus.write(tmp_path_factory.mktemp("single"), some) + "/documents.parquet")
    kept = simhash.stage_near_dedup(spark, single, "")
    assert "Aggregate" not in plan(kept)
    assert {r["doc_id"] for r in kept.collect()} == set(range(8))
    # repeated: one that stays, one that stays under null and empty text, one that another document stands for
    some += [{**some[3], "source": "r"}] * 4 + [{**some[2], "doc_id": 20}] * 3
    some += [{**some[0], "doc_id": 30, "text": t, "source": s} for t, s in ((None, "z"), ("", "a"), ("", "b"))]
    docs = spark.read.parquet(corpus.write(tmp_path_factory.mktemp("repeated"), some) + "/documents.parquet").repartition(3)
    results = []
    for most in (simhash.BROADCAST_NAMES, 0):  # few and many repeated documents
        monkeypatch.setattr(simhash, "BROADCAST_NAMES", most)
        kept = simhash.stage_near_dedup(spark, docs, "")
        assert kept.schema == docs.schema
        results.append(sorted((r["doc_id"], r["text"], r["source"]) for r in kept.fillna({"text": "null"}).collect()))
    want = [(d["doc_id"], d["text"], "r" if d["doc_id"] == 3 else "s") for d in some[:8]] + [(30, "null", "z")]
    assert results == [want, want]


def test_copies_at_anchors_are_made_by_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PLACED", 100)
    seen, anchored = [], simhash.anchored
    monkeypatch.setattr(simhash, "anchored", lambda fps: seen.append(fps) or anchored(fps))
    rng = random.Random(11)
    fps = [rng.getrandbits(63) for _ in range(950)]
    found = simhash.links(spark.createDataFrame([(x,) for x in fps] + [(fps[0] ^ 7,)], "fp long")).collect()
    assert {frozenset(r) for r in found} == {frozenset((fps[0], fps[0] ^ 7))}
    assert seen[0].rdd.getNumPartitions() == 10


def test_a_worker_keeps_the_state_of_one_operator():
    first = batches.keep(("test", 1), list)
    assert batches.keep(("test", 1), list) is first
    second = bpe.encoder(bpe.RANKS, bpe.public_tokenizers.PATTERN)
    assert bpe.encoder(bpe.RANKS, bpe.public_tokenizers.PATTERN) is second and list(batches._kept.values()) == [second]
    batches.let_go()
    assert not batches._kept


def test_batches_are_worked_on_in_bounded_parts():
    texts = ["a" * 40, None, "", "b" * 70, "c" * 300, "é" * 10, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["k", "text"])
    found = list(batches.parts(batch, 1, 100))
    assert [p.column(0).to_pylist() for p in found] == [[0, 1, 2], [3], [4], [5, 6]]
    assert pa.Table.from_batches(found) == pa.Table.from_batches([batch])
    assert list(batches.parts(batch.slice(0, 0), 1)) == []
