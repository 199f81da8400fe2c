"""Each query over a small corpus with awkward rows, against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus
from plinth.llm import batches, bpe, decontaminate, kneser_ney, language_id, quality, registry, sampling, simhash, suffix_dedup, token_counts, toxicity, warc
from plinth.llm.batches import span_hashes

DOCS = corpus.rows()


def raw(doc: dict) -> bytes:
    return (doc["text"] or "").encode()


def by_row(rows, *columns: str) -> Counter:
    return Counter(tuple(r[c] for c in columns) for r in rows)


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    return corpus.write(tmp_path_factory.mktemp("sf"), DOCS, {"anchor": "x", "start": "y", "_kept": "z", "fp": "u", "score": "v"})


@pytest.fixture(scope="module")
def nothing(tmp_path_factory):
    return corpus.write(tmp_path_factory.mktemp("none"), [])


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_empty_tables(spark, nothing, name):
    assert registry.QUERIES[name](spark, nothing).collect() == []


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if "warc" not in n and "search" not in n])
def test_a_row_for_each_row(spark, sf, name):
    ids = [r["doc_id"] for r in registry.QUERIES[name](spark, sf).collect()]
    assert Counter(ids) == Counter(d["doc_id"] for d in DOCS)


# --- toxicity ------------------------------------------------------------------------------------


def test_toxicity(spark, sf):
    rows = toxicity.op1_toxicity(spark, sf).collect()
    for r in rows:
        assert r["held_out"] == (corpus.remainder(r["doc_id"], 5) == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    truth = {d["doc_id"]: int(any(i in (d["text"] or "") for i in corpus.INSULTS)) for d in DOCS}
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.85
    scores = {r["doc_id"]: r["score"] for r in rows if r["doc_id"] in (60, 61, 62, 63)}
    assert len(set(scores.values())) == 1  # equal texts


def _gram_buckets(text: bytes, sizes, bits: int) -> list[int]:
    """The bucket of each n-gram, n by n, in plain integers."""
    out = []
    for n in sizes:
        for i in range(len(text) - n + 1):
            h = 0
            for byte in text[i:i + n]:
                h = (h * 1000003 + byte + 1) % 2**64
            out.append((h + n) * 0x9E3779B97F4A7C15 % 2**64 >> (64 - bits))
    return out


def test_toxicity_scales_by_log_count_ratios(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    truth = {}
    for r in corpus.labels(DOCS):
        if r["doc_id"] is not None and r["toxic"] is not None:
            truth[r["doc_id"]] = max(r["toxic"], truth.get(r["doc_id"], 0))
    sets = {d["doc_id"]: set(_gram_buckets(b" " + raw(d).lower() + b" ", toxicity.SIZES, toxicity.BITS)) for d in DOCS}
    seen = {k: Counter(b for i in truth if truth[i] == k for b in sets[i]) for k in (0, 1)}
    n = Counter(truth.values())
    for b in set(seen[0]) | set(seen[1]):
        ratio = math.log((seen[1][b] + 1) / (n[1] + 2)) - math.log((seen[0][b] + 1) / (n[0] + 2))
        clear = abs(ratio) >= toxicity.MIN_RATIO and seen[0][b] + seen[1][b] >= toxicity.MIN_TEXTS
        assert clear or model.weights[b] == 0
    assert set(np.flatnonzero(model.weights)) <= set(seen[0]) | set(seen[1])
    for r in toxicity.score(docs, model).collect():
        if r["doc_id"] is not None:
            margin = model.bias + sum(float(model.weights[b]) for b in sets[r["doc_id"]])
            assert math.isclose(r["score"], 1 / (1 + math.exp(-margin)), rel_tol=1e-6)


def test_rare_labels_are_not_lost_to_the_bound(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(1000)], "doc_id long, text string")
    rows = [(k, int(k % 50 == 0)) for k in range(1000)] + [(k, 1) for k in range(5000, 5400)] + [(7, None), (None, 1), (50, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    chosen, shift = sampling.labelled_ids(docs, labels, "doc_id", "toxic", 100)
    got = chosen.collect()
    assert {r["_id"] for r in got if r["_label"]} == set(range(0, 1000, 50))  # all 20 of them
    assert len(got) == 100 == len({r["_id"] for r in got})
    assert math.isclose(shift, math.log(20 / 980) - math.log(20 / 80))
    assert sampling.labelled_ids(docs, labels, "doc_id", "toxic", 5000)[1] == 0
    one_kind, shift = sampling.labelled_ids(docs, labels.where("toxic = 0"), "doc_id", "toxic", 100)
    assert (one_kind.count(), shift) == (100, 0)


# --- suffix arrays -------------------------------------------------------------------------------


def brute_repeats(texts: list[bytes], length: int) -> list[np.ndarray]:
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                hit[i:i + length] = True
        out.append(hit)
    return out


@pytest.mark.parametrize("hot, part", [(4000, 1 << 20), (1, 700)])
def test_suffix_dedup(spark, sf, monkeypatch, hot, part):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(suffix_dedup, "HASHED_BYTES", part)
    texts = [raw(d) for d in DOCS]
    want = Counter()
    for d, t, hit in zip(DOCS, texts, brute_repeats(texts, 200)):
        spans = int((np.diff(hit.astype(int), prepend=0) == 1).sum())
        left = bytes(b for b, h in zip(t, hit) if not h)
        want[(d["doc_id"], len(t), int(hit.sum()), spans, hashlib.sha256(left).hexdigest())] += 1
    got = by_row(suffix_dedup.op2_suffix_dedup(spark, sf).collect(), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == want
    assert sum(k[2] for k in want) > 5000


def test_two_stage_sort_is_a_suffix_array():
    rng = np.random.default_rng(4)
    for size, alphabet in ((1, 2), (2, 2), (300, 2), (2000, 4), (500, 1)):
        text = rng.integers(97, 97 + alphabet, size).astype(np.uint8)
        whole = text.tobytes()
        order = suffix_dedup.two_stage_sort(text, size)
        assert order.tolist() == sorted(range(size), key=lambda i: whole[i:])
        shared = suffix_dedup.common_prefixes(text, order, 40)
        for a, b, n in zip(order[:-1], order[1:], shared):
            x, y = whole[a:a + 40], whole[b:b + 40]
            same = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert min(n, len(x), len(y)) == same or n == 40


# --- tokens --------------------------------------------------------------------------------------


def test_token_counts(spark, sf):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for d in DOCS:
        n = len(model.encode(d["text"] or "", add_special_tokens=False).ids)
        want[(d["doc_id"], len(raw(d)), n, n > 1024)] += 1
    assert by_row(token_counts.op3_token_counts(spark, sf).collect(), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_token_counts_of_other_libraries(spark, sf, name):
    rows = token_counts.count_tokens(spark.read.parquet(f"{sf}/documents.parquet"), vocabulary=name).collect()
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        count = lambda t: len(model.encode(t))
    else:
        model = Tokenizer.from_file(public_tokenizers.path(name))
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    assert by_row(rows, "doc_id", "n_tokens") == Counter((d["doc_id"], count(d["text"] or "")) for d in DOCS)


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b", "a \n b", "a b", "x  y", "\t a  "])
def test_safe_pieces_join_to_the_text(text):
    assert "".join(token_counts.safe_pieces(text)) == text


def _tiktoken() -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={})


def test_bpe(spark, sf):
    model, want = _tiktoken(), Counter()
    for d in DOCS:
        ids = model.encode_ordinary(d["text"] or "")
        want[(d["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw(d)).hexdigest())] += 1
    got = by_row(bpe.op7_bpe(spark, sf).collect(), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == want


def test_long_words_merge_alike():
    fold, model = bpe.Merges(bpe.load_ranks()).fold, _tiktoken()
    for word in ("thequick" * 40, "a" * 700, "xyzü" * 100):
        assert fold([word.encode()])[0] == model.encode_ordinary(word)


def test_folded_merges_and_joined_pieces(spark):
    ranks = bpe.load_ranks()
    words = sorted({w.encode() for d in DOCS[:12] for w in bpe.Encoder(bpe.RANKS, public_tokenizers.PATTERN).split(d["text"])})[:150] + [b"", b"a" * 40]
    folded = dict(zip(words, bpe.Merges(ranks).fold(words)))
    rows = spark.createDataFrame([(w,) for w in words], "w binary").withColumn("ids", bpe.fold_merges(F.col("w"), ranks))
    for r in rows.withColumn("bytes", bpe.join_pieces(F.col("ids"), ranks)).collect():
        w = bytes(r["w"])
        assert list(r["ids"]) == folded[w] and bytes(r["bytes"]) == w


def test_ranks_are_the_files():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        token, rank = f.readline().split()
    assert bpe.load_ranks()[base64.b64decode(token)] == int(rank)


# --- language ------------------------------------------------------------------------------------


def test_language(spark, sf):
    rows = language_id.op4_language_id(spark, sf).collect()
    texts = {d["doc_id"]: d for d in DOCS}
    right = []
    for r in rows:
        d = texts[r["doc_id"]] if r["doc_id"] is not None else None
        assert r["held_out"] == (corpus.remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1
        if d and not any(c.isalpha() for c in d["text"] or ""):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif d and d["doc_id"] < 60:
            right.append(r["lang_pred"] == d["lang"])
        if d and r["lang_pred"] != "und":
            assert r["lang_pred"] in ("en", "de")
    assert np.mean(right) > 0.95


def test_no_language_is_lost_to_the_bound(spark, monkeypatch):
    monkeypatch.setattr(language_id, "ROWS", 20)
    rows = [(20 * k + i, f"text {k} word", f"common{k}") for k in range(4) for i in range(20)]
    rows += [(1000 + k, f"other {k} word", f"rare{k}") for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.fit(docs).languages == sorted({lang for _, _, lang in rows})


def test_decoding_takes_the_least_weighted_loss():
    rng = np.random.default_rng(3)
    code = language_id.codewords(5)
    trust = rng.random(code.shape[1])
    model = language_id.Model(list("abcde"), code, np.zeros((1, code.shape[1])), np.zeros(code.shape[1]), trust / trust.sum())
    values = rng.normal(0, 2, (40, code.shape[1]))
    best, score, doubt = language_id.decode(values, model)
    for k, row in enumerate(values):
        loss = [sum(t * math.log1p(math.exp(-v * c)) for v, c, t in zip(row, word, model.trust)) for word in code]
        first, second = sorted(loss)[:2]
        assert loss[best[k]] == pytest.approx(first) and bool(doubt[k]) == (second - first < language_id.LEAD)
        assert score[k] == pytest.approx(1 / sum(math.exp((first - x) * len(trust)) for x in loss))


def test_margins_are_mean_weights_of_grams():
    rng = np.random.default_rng(8)
    weights = rng.normal(0, 1, (1 << language_id.BITS, 3)).astype(np.float32)
    model = language_id.Model(["a", "b"], np.ones((2, 3)), weights, rng.normal(0, 1, 3), np.ones(3) / 3)
    texts = [raw(d) for d in DOCS if len(raw(d)) < 3000]
    for text, got in zip(texts, language_id.margins(texts, model)):
        folded = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in b" " + text + b" ")
        found = _gram_buckets(folded, language_id.SIZES, language_id.BITS)
        assert got == pytest.approx(weights[found].astype(float).mean(0) + model.bias, rel=1e-6, abs=1e-9)


def test_codewords_differ_in_several_bits():
    for k in (2, 3, 4, 5, 6, 7, 9, 30):
        code = language_id.codewords(k)
        bits = {tuple(b * b[0]) for b in code.T}
        assert len(bits) == code.shape[1] and all(min(b) < 0 for b in bits)
        distance = ((code[:, None] != code[None]).sum(2) + np.eye(k) * 10**6).min()
        assert distance >= (1 if k == 2 else 2 if k == 3 else 4)


# --- quality -------------------------------------------------------------------------------------


def test_quality_counts(spark, sf):
    want = {}
    for d in DOCS:
        text = d["text"] or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search("[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        hit = set()
        for i in range(len(words) - 7):
            if windows[tuple(words[i:i + 8])] > 1:
                hit.update(range(i, i + 8))
        failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
        want[text] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed)
    texts = {d["doc_id"]: d["text"] or "" for d in DOCS}
    for r in quality.op5_quality(spark, sf).collect():
        if r["doc_id"] is None:
            continue
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == want[texts[r["doc_id"]]]
        assert not (r["kept"] and r["base_failed"])


def test_quality_learns(spark, sf):
    truth = {d["doc_id"]: "%%%" not in (d["text"] or "") for d in DOCS}
    rows = [r for r in quality.op5_quality(spark, sf).collect() if r["doc_id"] is not None and r["doc_id"] < 60 and not r["base_failed"]]
    assert np.mean([r["kept"] == truth[r["doc_id"]] for r in rows]) > 0.9


def test_quality_probability_is_of_mean_weights():
    rng = np.random.default_rng(6)
    weights = rng.normal(0, 1, 1 << quality.BITS).astype(np.float32)
    model = quality.Model(weights, 0.3, 0.7, -0.2)
    texts = [raw(d) for d in DOCS if len(raw(d)) < 3000]

    def word(w: bytes) -> int:
        return int(span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])

    for text, got in zip(texts, quality.probabilities(quality.Piece(texts), model)):
        kinds = [_gram_buckets(text, [n], quality.BITS) for n in quality.CHAR_SIZES]
        hashes = [word(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", text)]
        pairs = batches.mix(np.array([(a * 31 + b) % 2**64 for a, b in zip(hashes, hashes[1:])], np.uint64)).tolist()
        kinds += [[h >> (64 - quality.BITS) for h in hs] for hs in (hashes, pairs)]
        margin = model.bias + quality.SCALE * sum(float(weights[k].astype(float).mean()) for k in kinds if k)
        assert got == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))), rel=1e-6)


# --- language model ------------------------------------------------------------------------------


def _tokens(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", lower) + ["</s>"]


def _discounts(counts: list[int]) -> list[float]:
    n = [sum(c == k for c in counts) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = [0.0]
    for k in range(1, 4):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * y
        out.append(min(max(d, 0.05), k))
    return out


def test_kneser_ney(spark, sf):
    train = [_tokens(d["text"]) for d in DOCS if corpus.remainder(d["doc_id"], 7) != 2]
    c1, c2 = Counter(t for x in train for t in x), Counter(p for x in train for p in zip(["<s>", *x], x))
    n, v = sum(c1.values()), len(c1)
    kinds, context = Counter(w for _, w in c2), defaultdict(list)
    for (a, _), c in c2.items():
        context[a].append(c)
    d1, d2 = _discounts(list(kinds.values())), _discounts(list(c2.values()))
    share = sum(d1[min(k, 3)] for k in kinds.values()) / len(c2)

    def probability(a: str, w: str) -> float:
        unigram = max(kinds[w] - d1[min(kinds[w], 3)], 0) / len(c2) + share / (v + 1)
        if a not in context:
            return unigram
        total, c = sum(context[a]), c2[(a, w)]
        return max(c - d2[min(c, 3)], 0) / total + sum(d2[min(k, 3)] for k in context[a]) / total * unigram

    for a in ("<s>", "the", train[0][0], "never seen"):
        assert math.isclose(sum(probability(a, w) for w in c1) + probability(a, "no such word"), 1, rel_tol=1e-9)
    want = {}
    for d in DOCS:
        x = _tokens(d["text"])
        base = sum(math.log10((c1[t] + 1) / (n + v + 1)) for t in x)
        want[d["text"]] = (len(x), sum(c1[t] > 0 for t in x), base, sum(math.log10(probability(a, w)) for a, w in zip(["<s>", *x], x)))
    texts = {d["doc_id"]: d["text"] for d in DOCS}
    for r in kneser_ney.op6_kneser_ney(spark, sf).collect():
        assert r["train_tokens"] == n and r["held_out"] == (corpus.remainder(r["doc_id"], 7) == 2)
        if r["doc_id"] is not None:
            tokens, known, base, score = want[texts[r["doc_id"]]]
            assert (r["n_tokens"], r["n_known"]) == (tokens, known)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)


def test_span_hashes_of_long_arrays(monkeypatch):
    buf = np.random.default_rng(2).integers(0, 256, 5000).astype(np.uint8)
    starts = np.arange(0, 4900, 7)
    whole = span_hashes(buf, starts, starts + 40)
    monkeypatch.setattr(batches, "PIECE_BYTES", 300)
    assert (span_hashes(buf, starts, starts + 40) == whole).all()


def test_span_hashes_depend_on_the_bytes_alone():
    buf = np.frombuffer(b"abc xabc abd", np.uint8)
    h = span_hashes(buf, np.array([0, 5, 9, 0]), np.array([3, 8, 12, 0]))
    assert h[0] == h[1] != h[2] and len(set(h.tolist())) == 3


# --- decontamination -----------------------------------------------------------------------------


def _words(text: str | None) -> list[bytes]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower.encode())


def _brute_hits(items: list[dict]):
    windows = defaultdict(set)
    for item in items:
        w = _words(item["text"])
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[i:i + 13])].add("null" if item["item_id"] is None else str(item["item_id"]))
    lengths = {len(w) for w in windows}
    for d in DOCS:
        w, hit, found = _words(d["text"]), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield d["doc_id"], len(w), len(hit), len(found), ids, len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_decontaminate(spark, sf, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rows = decontaminate.op8_decontaminate(spark, sf).collect()
    got = by_row(rows, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == Counter(_brute_hits(corpus.benchmark(DOCS)))
    assert 2 < sum(r["contaminated"] for r in rows) < len(rows)


def test_decontaminate_equals_its_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = Counter(con.sql(f"SELECT {', '.join(columns)} FROM ({decontaminate.OP8_SQL})").fetchall())
    assert by_row(decontaminate.op8_decontaminate(spark, sf).collect(), *columns) == want


def test_longest_matches(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [r for r in decontaminate.matches(docs, items).collect() if r["doc_id"] == 1]
    assert {(r["word"], r["item_id"], r["item_word"], r["n_words"]) for r in rows if r["item_id"] in ("0", "null")} == {(0, "0", 0, len(_words(corpus.benchmark(DOCS)[0]["text"]))), (0, "null", 0, len(_words(corpus.benchmark(DOCS)[0]["text"])))}


# --- archives ------------------------------------------------------------------------------------


def test_warc(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = Counter(con.sql(f"SELECT {', '.join(columns)} FROM ({warc.OP9_SQL})").fetchall())
    assert by_row(warc.op9_warc(spark, sf).collect(), *columns) == want


def test_records_are_rebuilt_whole(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    again = pages.unionByName(pages.where("page_id = 1")).unionByName(pages.where("page_id = 2").selectExpr("CAST(NULL AS BIGINT) page_id", "url", "html"))
    archive = warc.write(again, warc.Archive(f"{tmp_path}/h", f"{tmp_path}/p"))
    rows = warc.read(spark, archive).collect()
    assert len(rows) == again.count()
    bodies = {p["page_id"]: (p["html"] or "").encode() for p in corpus.pages()}
    for r in rows:
        number = re.search(r"urn:page:(\w+)>", r["header"])[1]
        body = bodies[2 if number == "none" else int(number)]
        assert bytes(r["payload"]) == body
        sent = b"" if "WARC-Type: revisit" in r["header"] else body
        assert bytes(r["record"]) == r["header"].encode() + sent + b"\r\n\r\n"
    want = Counter(p["url"] for p in corpus.pages()) + Counter(p["url"] for p in corpus.pages() if p["page_id"] in (1, 2))
    assert Counter(r["url"] for r in rows) == want
    assert all(not re.search(r"[\x00-\x09\x0b\x0c\x0e-\x1f\x7f]", r["header"]) and r["header"].count("\r\nWARC-Type: ") == 1 for r in rows)
    stored = spark.read.parquet(archive.payloads)
    assert stored.count() == len(set(bodies.values()))


def test_a_changed_payload_is_noticed(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    archive = warc.write(pages, warc.Archive(f"{tmp_path}/h", f"{tmp_path}/p"))
    spoiled = f"{tmp_path}/q"
    spark.read.parquet(archive.payloads).selectExpr("payload_key", "concat(payload, CAST('x' AS BINARY)) payload").write.parquet(spoiled)
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, warc.Archive(archive.headers, spoiled)).collect()


# --- SimHash -------------------------------------------------------------------------------------


def brute_fingerprint(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps: list[int]) -> list[int]:
    label = list(range(len(fps)))

    def find(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash(spark, sf):
    fps = [brute_fingerprint(d["text"]) for d in DOCS]
    groups = defaultdict(list)
    for d, c in zip(DOCS, brute_components(fps)):
        groups[c].append(d["doc_id"])
    want = Counter()
    for d, fp, c in zip(DOCS, fps, brute_components(fps)):
        ids = [i for i in groups[c] if i is not None]
        want[(d["doc_id"], f"{fp:016x}", min(ids) if ids else None)] += 1
    assert by_row(simhash.op10_simhash(spark, sf).collect(), "doc_id", "fingerprint", "component_id") == want


@pytest.mark.parametrize("crowd", [100_000, 4])
def test_links_find_every_pair(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = set()
    for c in centres.tolist():
        for _ in range(40):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    reached = simhash.stars(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()
    roots = {r["u"]: r["v"] for r in reached}
    got, want = defaultdict(set), defaultdict(set)
    for x, s, c in zip(fps, signed, brute_components(fps)):
        got[roots.get(s, s)].add(x)
        want[c].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_a_lost_model_file_is_an_error(spark, sf):
    import os

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = kneser_ney.train(docs)
    words = model.arrays()[1]
    kept = [words.path(s, "hash") for s in range(1 << words.bits)]
    assert all(map(os.path.exists, kept))
    broken = kneser_ney.Mapped(words.place + "-gone", "words", words.kinds, words.bits)
    with pytest.raises(FileNotFoundError):
        broken.get(np.arange(4, dtype=np.uint64))
