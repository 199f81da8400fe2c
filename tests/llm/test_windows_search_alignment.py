"""Word windows, ranked search and token alignment against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus
from plinth.llm import alignment, lexical_search, substring_dedup, words

DOCS = corpus.rows()
CLASHES = {"t1": "x", "found": "y", "_kept": "z", "bucket": "u", "rank": "v", "pairs": "w"}


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    return corpus.write(tmp_path_factory.mktemp("sf"), DOCS, CLASHES)


def by_row(rows, *columns: str) -> Counter:
    return Counter(tuple(r[c] for c in columns) for r in rows)


# --- parts of texts ------------------------------------------------------------------------------


def test_cut_covers_the_text_and_no_word_is_cut():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab \n") for _ in range(rng.randrange(60))).encode()
        limit = rng.randint(1, 9)
        ranges = list(words.cut(text, limit))
        assert b"".join(text[a:b] for a, b in ranges) == text
        assert [w for a, b in ranges for w in text[a:b].split()] == text.split()
        rows, parts = zip(*[(r, p) for rs, ps in words.groups([text, b"", text], limit) for r, p in zip(rs, ps)])
        assert list(rows) == sorted(rows)
        assert [b"".join(p for r, p in zip(rows, parts) if r == k) for k in range(3)] == [text, b"", text]


# --- word windows --------------------------------------------------------------------------------


def brute_windows(texts: list[str | None]) -> list[tuple[int, int, str]]:
    every = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i:i + 35]) for w in every for i in range(len(w) - 34))
    out = []
    for w in every:
        hit = np.zeros(len(w), bool)
        for i in range(len(w) - 34):
            if count[tuple(w[i:i + 35])] > 1:
                hit[i:i + 35] = True
        left = b" ".join(x for x, h in zip(w, hit) if not h)
        out.append((len(w), int(hit.sum()), hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("settings", [
    {}, {"GATHERED_BYTES": 3000, "BUCKET_BYTES": 2000}, {"GATHERED_BYTES": 1 << 30, "MOST_WINDOWS": 3},
])
def test_substring_dedup(spark, sf, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(substring_dedup, name, value)
    want = Counter((d["doc_id"], *w) for d, w in zip(DOCS, brute_windows([d["text"] for d in DOCS])))
    got = by_row(substring_dedup.op11_substring_dedup(spark, sf).collect(), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == want
    assert sum(k[2] for k in want) > 2000


def hot_rows() -> list[dict]:
    """A line that everybody quotes in different surroundings, a passage that many share, copies, and few different words."""
    rng = random.Random(9)
    line = "as everybody knows this line stands in every text there is".split()
    passage = [f"p{k}" for k in range(60)]
    copy = [f"c{rng.randrange(50)}" for _ in range(90)]
    texts = []
    for k in range(240):
        own = [f"w{rng.randrange(400)}" for _ in range(rng.randint(20, 80))]
        if k % 3 == 0:
            own[10:10] = line
        if k % 4 == 0:
            own += passage
        if k % 5 == 0:
            own = copy
        if k % 7 == 0:
            own = [rng.choice("xy") for _ in range(300)]
        texts.append("  ".join(own) if k % 2 else " ".join(own) + "\n")
    return [{"doc_id": k, "text": t, "lang": "en", "source": "hot", "n_chars": len(t)} for k, t in enumerate(texts)]


@pytest.mark.parametrize("heavy", [0, 8, 1 << 16])
def test_hot_lines_and_passages(spark, tmp_path, monkeypatch, heavy):
    monkeypatch.setattr(substring_dedup, "HEAVY", max(heavy, 1))
    if not heavy:
        monkeypatch.setattr(substring_dedup, "heavy_grams", lambda texts: (np.zeros(0, np.uint64), 1 << 24))
    rows = hot_rows()
    docs = spark.read.parquet(corpus.write(tmp_path, rows) + "/documents.parquet").repartition(5)
    kept = substring_dedup.remove_repeats(docs, carry=["doc_id"])
    got = by_row(kept.select("doc_id", "_kept.*").collect(), "doc_id", "n_words", "n_removed", "sha256")
    assert got == Counter((d["doc_id"], *w) for d, w in zip(rows, brute_windows([d["text"] for d in rows])))


def test_heavy_grams_are_those_of_the_common_line(spark, tmp_path):
    docs = spark.read.parquet(corpus.write(tmp_path, hot_rows()) + "/documents.parquet")
    texts = docs.selectExpr("doc_id t1", "doc_id t2", "text")
    heavy, size = substring_dedup.heavy_grams(texts)
    assert size == sum(len(d["text"].encode()) for d in hot_rows())
    line = words.placed([b"as everybody knows this line stands in every text there is"])[1]
    grams = substring_dedup.mix(words.rolled(line, substring_dedup.GRAM))
    assert set(grams.tolist()) <= set(heavy.tolist()) and (np.diff(heavy.astype(object)) > 0).all()


def test_equal_windows_have_equal_minimisers():
    rng = random.Random(4)
    shared = [f"s{k}" for k in range(50)]
    texts = [" ".join([f"a{rng.random()}" for _ in range(n)] + shared + [f"b{rng.random()}" for _ in range(n)]).encode() for n in (0, 3, 40)]
    _, hashes, _, _, first, last = words.placed(texts)
    seen = defaultdict(set)
    for heavy in (np.zeros(0, np.uint64), np.sort(substring_dedup.mix(words.rolled(words.placed([" ".join(shared).encode()])[1], 5)))):
        text, start, n, least = substring_dedup.super_kmers(hashes, first, last, heavy)
        covered = Counter()
        for t, s, k, m in zip(text, start, n, least):
            for w in range(s, s + k):
                assert first[t] <= w and w + 35 <= last[t]
                covered[w] += 1
                seen[len(heavy), tuple(hashes[w:w + 35].tolist())].add(int(m))
        assert set(covered.values()) == {1} and len(covered) == sum(max(b - a - 34, 0) for a, b in zip(first, last))
    assert all(len(m) == 1 for m in seen.values())


def test_one_long_text(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(120_000)]
    text = " ".join(base + base[500:900])
    rows = substring_dedup.remove_repeats(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()
    _, removed, digest = brute_windows([text])[0]
    assert (rows[0]["_kept"]["n_removed"], rows[0]["_kept"]["sha256"]) == (removed, digest) and removed == 800
    assert hashlib.sha256(rows[0]["_kept"]["text"].encode()).hexdigest() == digest


# --- ranked search -------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs: list[dict], items: list[dict], top: int) -> Counter:
    bags = [Counter(terms(d["text"])) for d in docs]
    n_docs, n_terms = sum(1 for b in bags if b), sum(b.total() for b in bags)
    held = Counter(t for b in bags for t in b)
    out = Counter()
    for item in items:
        found = []
        for d, bag in zip(docs, bags):
            n, score = bag.total(), 0
            for t in terms(item["text"]):
                if t in bag:
                    m = 75 + 25 * n * n_docs // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                    score += w * (1000000000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                found.append((-score, d["doc_id"] is None, d["doc_id"] or 0))
        for rank, (score, none, i) in enumerate(sorted(found)[:top], 1):
            out[item["item_id"], rank, None if none else i, -score] += 1
    return out


@pytest.mark.parametrize("settings", [{}, {"BLOCK_BYTES": 200, "CELLS": 500, "PARTS": 2}])
def test_search(spark, sf, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(lexical_search, name, value)
    want = brute_search(DOCS, corpus.benchmark(DOCS), 20)
    got = by_row(lexical_search.op12_lexical_search(spark, sf).collect(), "item_id", "rank", "doc_id", "score")
    assert got == want and len(want) > 60


def test_search_sql(sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    rows = con.execute(lexical_search.OP12_SQL)
    assert [c[0] for c in rows.description] == ["item_id", "rank", "doc_id", "score"]
    assert Counter(rows.fetchall()) == brute_search(DOCS, corpus.benchmark(DOCS), 20)


def test_search_takes_other_columns_and_counts(spark):
    docs = spark.createDataFrame([(None, "a b"), (3, "a b"), (2, "a b"), (2, "a b"), (9, None)], "id int, body string")
    items = spark.createDataFrame([("x", "b a a"), ("x", "zz"), (None, "b")], "name string, words string")
    rows = lexical_search.search(docs, items, "id", "body", "name", "words", top=3).collect()
    # every term stands in every document that has one, so the weight is that of 10 / 9
    assert by_row(rows, "item_id", "rank", "doc_id") == Counter([(k, n, i) for k in ("x", None) for n, i in ((1, 2), (2, 2), (3, 3))])
    assert all(type(r["rank"]) is int for r in rows)


def test_long_document_is_counted_in_parts():
    text = b"one two three " * 400_000
    (rows, size, found), = lexical_search.counted([text], np.sort(words.placed([b"two four"])[1]), 16)
    assert size.tolist() == [1_200_000] and sorted(found[0].tolist()) == [0, 400_000]


def test_shared_sets_are_computed_once_and_add_up():
    rng = random.Random(1)
    base = [rng.randrange(60) for _ in range(25)]
    items = [[*base[:rng.randint(10, 25)], *[rng.randrange(60) for _ in range(6)]] for _ in range(30)] + [[5], [5, 5, 5]]
    graph = lexical_search.share(items, 60)
    leaves = np.array([[rng.randrange(1000) for _ in range(4)] for _ in range(60)])
    cells = np.zeros((graph.nodes, 4), np.int64)
    cells[:60] = leaves
    assert graph.fill(cells).tolist() == [leaves[i].sum(0).tolist() for i in items]
    assert graph.nodes > 60
    additions = len(graph.children) + sum(len(c) for c, _ in graph.levels)
    assert additions < 0.8 * sum(map(len, items))


# --- alignment -----------------------------------------------------------------------------------


def brute_tokens(text: str | None) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]]:
    if not text:
        return [], []
    a_model, b_model = brute_tokens.models
    whole = (" " + text).encode()
    letters = alignment._byte_letters()
    a = [(i, bytes(letters[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in b_model.encode(text):
        piece = b_model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()))
    if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
        return [], []
    return a, b


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    brute_tokens.models = a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_alignment(texts: list[str | None]) -> list[tuple]:
    pairs, per_text = Counter(), []
    for text in texts:
        a, b = brute_tokens(text)
        ends_a, ends_b = (np.cumsum([len(t) for _, t in s]).astype(int).tolist() for s in (a, b))
        links = [(a[i][0], b[j][0]) for i, e in enumerate(ends_a) for j in [ends_b.index(e) if e in ends_b else -1] if j >= 0]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(str(t) for t, _ in a[i:x]) + "|" + ",".join(str(t) for t, _ in b[j:y]))
            i, j = x, y
        pairs.update(links)
        per_text.append((len(a), len(b), links, groups))
    most = defaultdict(int)
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(pairs[p] == most[p[1]] for p in links), sum(pairs[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for n_a, n_b, links, groups in per_text
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("settings", [{}, {"SEGMENT": 200, "LANE": 3, "WIDEST": 4, "KEPT_PIECES": 40, "CALL": 7}])
def test_alignment(spark, models, tmp_path, monkeypatch, settings):
    extra = ["▁ already there", "a▁", "fullwidth ＡＢ", "tabs\t\tand  spaces   ", "   ", " x", "<s> </s> <unk> <0x41>", "\x00", "é" * 300, "  　x", "🙂🙂 🙂"]
    rows = [d for d in DOCS if len(d["text"] or "") < 3000]
    rows = rows + [{"doc_id": 500 + k, "text": t, "lang": "en", "source": "s", "n_chars": 1} for k, t in enumerate(extra)]
    sf = corpus.write(tmp_path, rows, CLASHES)
    if settings:  # tasks run in processes of their own, so the settings are tried here
        for name, value in settings.items():
            monkeypatch.setattr(alignment, name, value)
        coder = alignment.Encoder(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
        found = alignment._aligned([(d["text"] or "").encode() for d in rows], coder)
        want = [(w[0], w[1], w[2], w[3], w[6]) for w in brute_alignment([d["text"] for d in rows])]
        assert [f[:5] for f in found] == want
    else:
        got = by_row(alignment.op13_token_alignment(spark, sf).collect(), "doc_id", *COLUMNS)
        want = Counter((d["doc_id"], *w) for d, w in zip(rows, brute_alignment([d["text"] for d in rows])))
        assert got == want
        assert sum(1 for w in want if w[1] == 0) >= 4


def test_pieces_give_the_tokens_of_whole_texts(models):
    coder = alignment.Encoder(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
    assert coder.cuts
    rng = random.Random(8)
    letters = ["a", "b", " ", " ", "  ", "\n", "\t", "'s", ".", "é", "日", "the", "ing", "1", "23", " ", "🙂"]
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 30)))
        numbers = coder.numbers(coder.pieces(" " + text))
        for side, tokens in enumerate(brute_tokens(text)):
            assert coder.tokens(numbers, side)[0].tolist() == [i for i, _ in tokens]


def test_diagonals_find_all_common_ends():
    rng = np.random.default_rng(3)
    for density in (0.05, 0.5, 0.97):
        for lanes in (1, 7):
            a, b, starts_a, starts_b, base = [], [], [], [], 0
            for _ in range(lanes):
                starts_a.append(len(a))
                starts_b.append(len(b))
                size = int(rng.integers(1, 2000))
                keep = rng.random((2, size)) < density
                same = rng.random(size) < density
                for k, out in enumerate((a, b)):
                    inside = np.flatnonzero(np.where(same, keep[0], keep[k])[:-1])
                    out.extend((base + 1 + inside).tolist())
                    out.append(base + size)
                base += size
            x, y = alignment.common_ends(np.array(a), np.array(b), np.array(starts_a), np.array(starts_b))
            common, i, j = np.intersect1d(a, b, return_indices=True)
            assert x.tolist() == i.tolist() and y.tolist() == j.tolist()


def test_pairs_are_bounded_by_the_vocabularies(spark, sf):
    a, b = alignment.tokens_a(alignment.VOCABULARY_A), alignment.tokens_b(alignment.VOCABULARY_B)
    bound = alignment.pair_bound(a, b)
    assert bound < 1_000_000
    pairs = alignment.pair_counts(alignment.aligned(spark.read.parquet(f"{sf}/documents.parquet"))).collect()
    assert len(pairs) < bound
    assert all(a[p["a"]].endswith(b[p["b"]]) or b[p["b"]].endswith(a[p["a"]]) for p in pairs)
    small = [b"a", b"ba", b"c", b""]
    assert alignment.pair_bound(small, [b"a", b"xa", b""]) == 3  # a-a, a-xa, ba-a


# --- all three -----------------------------------------------------------------------------------


@pytest.mark.parametrize("query", [substring_dedup.op11_substring_dedup, lexical_search.op12_lexical_search, alignment.op13_token_alignment])
def test_empty_tables(spark, tmp_path, query):
    assert query(spark, corpus.write(tmp_path, [])).collect() == []


def test_empty_items_and_null_texts(spark, tmp_path):
    rows = [{"doc_id": k, "text": None, "lang": None, "source": None, "n_chars": None} for k in (1, 1, None)]
    corpus.write(tmp_path, [])
    pq.write_table(pa.Table.from_pylist(rows, corpus.SCHEMA), f"{tmp_path}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), f"{tmp_path}/benchmark.parquet")
    assert lexical_search.op12_lexical_search(spark, str(tmp_path)).collect() == []
    empty = hashlib.sha256(b"").hexdigest()
    kept = substring_dedup.op11_substring_dedup(spark, str(tmp_path)).collect()
    assert by_row(kept, "n_words", "n_removed", "kept_sha256") == Counter({(0, 0, empty): 3})
    assert by_row(alignment.op13_token_alignment(spark, str(tmp_path)).collect(), *COLUMNS) == Counter({(0, 0, 0, 0, 0, 0, ""): 3})


def test_kept_pieces_take_four_bytes_an_id(models):
    coder = alignment.Encoder(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
    numbers = coder.numbers([" one", " two", " one"])
    assert [x.itemsize for x in coder.ids] == [4, 4] and numbers.tolist()[0] == numbers.tolist()[2]
    assert all(coder.tokens(numbers, k)[0].dtype == np.int64 for k in (0, 1))  # pairs are packed from them
    assert alignment.KEPT_PIECES <= 300_000 and alignment.ROWS <= 1000
