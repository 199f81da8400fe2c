"""Token counts: a tokenizer library run in Arrow functions that return lengths only.

Texts are cut at boundaries which no token crosses; the library encodes each distinct piece of a
batch once, in calls balanced by bytes. The batches of a scan are balanced by bytes already.

Defined cases: a null text is empty and has no tokens; equal rows are counted alike; ids may be
null or repeat. Only the two named columns are read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plinth.llm.batches import documents, utf8

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
#: Bytes of text given to the library in one call.
CALL_BYTES = 256 << 10
#: Pieces whose lengths a task keeps; beyond it starts anew.
KEPT_PIECES = 400_000

_UNSAFE = re.compile(r"\s ")


def safe_pieces(text: str) -> list[str]:
    """Cut before every space that follows something other than white space.

    The splitting pattern of byte-level BPE lets white space begin a token but never follow one
    inside it, so no token crosses such a place, and joining the pieces gives the text.
    """
    parts = text.split(" ")
    if len(parts) < 2:
        return parts if text else []
    if _UNSAFE.search(text) is None and text[0] != " ":
        first = parts.pop(0)
        out = [f" {p}" for p in parts]
        out.insert(0, first)
        return out
    out, open_piece = [], parts[0]
    for part in parts[1:]:
        if open_piece and not open_piece[-1].isspace():
            out.append(open_piece)
            open_piece = " " + part
        else:
            open_piece += " " + part
    out.append(open_piece)
    return out


def _lengths(vocabulary: str) -> Callable[[list[str]], list[int]]:
    """The library's token counts of many pieces, without begin, end or added special tokens."""
    path = public_tokenizers.path(vocabulary)
    if vocabulary.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def _calls(texts: list[str]) -> Iterator[list[str]]:
    """Groups of about ``CALL_BYTES``."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= CALL_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def count_tokens(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, vocabulary: str = VOCABULARY,
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row.

    Only byte-level vocabularies are cut into pieces; others see each text whole.
    """
    id_type = docs.schema[doc_id].dataType
    split = safe_pieces if vocabulary.startswith("byte_bpe") else lambda t: [t] if t else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, known = _lengths(vocabulary), {}
        for batch in batches:
            texts = utf8(batch.column(1))
            counts = []
            for raw in texts:
                parts = split(raw.decode())
                if len(known) > KEPT_PIECES:
                    known.clear()
                missing = [p for p in dict.fromkeys(parts) if p not in known]
                for call in _calls(missing):
                    known.update(zip(call, lengths(call)))
                counts.append(sum(map(known.__getitem__, parts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])
    return docs.select(doc_id, text).mapInArrow(run, schema)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))
