"""Byte-level BPE with the tiktoken library and a local rank file: encode and decode.

A text of more than ``STEP_BYTES`` is no special case: all texts are cut at places that
no match of the split pattern can cross (see ``tokens``), and only distinct pieces go
through the library. Decoding joins the raw bytes of the tokens.

Cases: a null or empty text has no tokens. Bytes that are no UTF-8 are read as the
replacement character, as tiktoken's decoder of strings does. Repeated rows give repeated
results. An empty table gives an empty result. Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import steps, text_bytes
from gatekit.llm.tokens import PATTERN, encoder


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            data, offs = text_bytes(b.column(1))
            for i, j in steps(offs):
                ids, count = enc.encode(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                at = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), lists], names=["doc_id", "ids"])
    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            raw = [enc.encoding.decode_bytes(x.as_py() or []) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])
    return run


def _round_trip(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        digits = [str(i) for i in range(len(enc.size))]
        for b in batches:
            data, offs = text_bytes(b.column(1))
            for i, j in steps(offs):
                ids, count = enc.encode(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                flat, k = ids.tolist(), 0
                text_of, bytes_of = [], []
                for n in count.tolist():
                    own = flat[k:k + n]
                    k += n
                    text_of.append(hashlib.sha256(",".join(map(digits.__getitem__, own)).encode()).hexdigest())
                    bytes_of.append(hashlib.sha256(enc.encoding.decode_bytes(own)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(count, pa.int64()), pa.array(text_of, pa.string()), pa.array(bytes_of, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _keyed(df: DataFrame, id: str, value: str) -> tuple[DataFrame, str]:
    rows = df.select(F.col(id).alias("doc_id"), F.col(value).alias("__value"))
    return rows, f"doc_id {rows.schema[0].dataType.simpleString()}"


def encode(docs: DataFrame, ranks: str, id: str = "doc_id", text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """(doc_id, ids array<int>) per row."""
    rows, key = _keyed(docs, id, text)
    return rows.mapInArrow(_encode(ranks, pattern), f"{key}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, id: str = "doc_id", ids: str = "ids", pattern: str = PATTERN) -> DataFrame:
    """(doc_id, bytes binary) per row; null ids give no bytes."""
    rows, key = _keyed(encoded, id, ids)
    return rows.mapInArrow(_decode(ranks, pattern), f"{key}, bytes binary")


def round_trip(docs: DataFrame, ranks: str, id: str = "doc_id", text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """Digests of the ids and of the decoded bytes, in one pass that ships no ids."""
    rows, key = _keyed(docs, id, text)
    return rows.mapInArrow(_round_trip(ranks, pattern), f"{key}, n_tokens long, ids_sha256 string, decoded_sha256 string")
