"""A small corpus with every awkward case, as rows and as Parquet tables."""

from __future__ import annotations

import random
import zlib

import pyarrow as pa
import pyarrow.parquet as pq

SYLLABLES = {
    "en": ["the", "ing", "er", "on", "and", "ther", "re", "ed", "at", "ou"],
    "de": ["sch", "ung", "keit", "ü", "ß", "lich", "der", "ein", "ver", "ö"],
}
INSULTS = ["blorkface", "zwackhead"]


def prose(rng: random.Random, lang: str, words: int) -> str:
    out = []
    for _ in range(words):
        out.append("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))))
        if rng.random() < 0.1:
            out[-1] += rng.choice([".", ",", ".\n", "!"])
    return " ".join(out)


def rows() -> list[dict]:
    rng = random.Random(11)
    texts: list[tuple[str | None, str | None]] = []
    passage = prose(rng, "en", 70)
    for k in range(60):
        lang = "en" if k % 2 else "de"
        text = prose(rng, lang, rng.randint(5, 160))
        if k % 7 == 3:
            text += "\n" + passage + " " + prose(rng, lang, 10)
        if k % 6 == 1:
            words = text.split(" ")
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
            text = " ".join(words)
        if k % 9 == 4:
            text = " ".join(w + "%%% |" for w in text.split(" "))
        texts.append((text, lang))
    base = prose(rng, "en", 150)
    texts += [(base, "en")] * 4
    for k in range(6):
        words = base.split(" ")
        words[20 * k + 3] = "changed" + str(k)
        texts.append((" ".join(words), "en"))
    texts += [
        (None, "en"), ("", "en"), (" \n\t ", "de"), ("12 34 !!", "en"), ("word", "en"), ("two words", "en"),
        ("ab " * 400, "en"), ("a" * 1500, "en"), ("same line of text\n" * 40, "en"), ("Ünï çødé 日本語 \U0001F600  x y", None),
        ("a  b   c \n d\t\te", "en"), ("<|endoftext|> x<|endoftext|>y", "en"), ("it's we'll I'D don't 'S", "en"),
        (prose(rng, "de", 6000), "de"), ("nul\x00byte \x1c\x85 odd", "en"),
    ]
    out = [{"doc_id": k, "text": t, "lang": lang, "source": "s", "n_chars": None if t is None else len(t)} for k, (t, lang) in enumerate(texts)]
    out.append(dict(out[5]))  # a repeated row
    out.append({"doc_id": None, "text": base, "lang": None, "source": None, "n_chars": None})
    out.append({"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None})
    return out


SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


def benchmark(docs: list[dict]) -> list[dict]:
    rng = random.Random(3)
    source = docs[1]["text"].lower().split()
    items = [" ".join(source[:20]), " ".join(source[3:19]), prose(rng, "de", 30), "two words", "", None, "!!", "Same line of text same line of text same LINE of text same line"]
    return [{"item_id": k, "text": t} for k, t in enumerate(items)] + [{"item_id": None, "text": items[0]}]


def pages() -> list[dict]:
    big, small = "<p>" + "x" * 1500, "<p>small"
    bodies = [big, big, small, small, big + "é", None, "", "<b>" + "é" * 600, big]
    out = [{"page_id": k, "url": f"http://h/{k}", "html": b} for k, b in enumerate(bodies)]
    odd = ["http://h/a b\r\nWARC-Type: x", None, "", "http://h/ab", "http://h/a b", "http://h/a%20b", "http://h/a+b%", "http://h/é ü\x00\x7f\t"]
    return out + [{"page_id": 40 + k, "url": u, "html": "y" * (999 + k)} for k, u in enumerate(odd)]


def labels(docs: list[dict]) -> list[dict]:
    out = []
    for d in docs:
        if d["doc_id"] is None or d["text"] is None:
            continue
        out.append({"doc_id": d["doc_id"], "quality": 0 if "%%%" in d["text"] else 1, "toxic": int(any(i in d["text"] for i in INSULTS))})
    return out + out[:1] + [{"doc_id": None, "quality": 1, "toxic": 1}, {"doc_id": 3, "quality": None, "toxic": None}]


def write(path, docs: list[dict], extra: dict | None = None) -> str:
    """The tables as Parquet files of a folder; ``extra`` adds constant text columns to the documents."""
    table = pa.Table.from_pylist(docs, SCHEMA)
    for name, value in (extra or {}).items():
        table = table.append_column(name, pa.array([value] * len(table), pa.string()))
    pq.write_table(table, f"{path}/documents.parquet")
    pq.write_table(pa.Table.from_pylist(labels(docs) if docs else [], pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("toxic", pa.int64())])), f"{path}/labels.parquet")
    pq.write_table(pa.Table.from_pylist(benchmark(docs) if docs else [], pa.schema([("item_id", pa.int64()), ("text", pa.string())])), f"{path}/benchmark.parquet")
    pq.write_table(pa.Table.from_pylist(pages() if docs else [], pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])), f"{path}/pages.parquet")
    return str(path)


def remainder(doc_id: int | None, divisor: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor
