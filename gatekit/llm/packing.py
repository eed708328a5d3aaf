"""Order-preserving packing of token streams into sequences by dynamic programming.

The documents of a scan partition, in their order, form one stream of tokens (each
document ends with a separator id). The stream is cut into windows of at most ``width``
tokens; a window that is shorter is padded to ``width`` unless its length is a power of
two. The cuts are chosen from the document and sentence ends to minimise

    padding + SENTENCE_CUT per cut inside a document at a sentence end
            + FORCED_CUT per cut where no sentence ends

``f(i) = min over j of f(j) + padding(p_i - p_j) + penalty_i`` over the candidate cuts
``p``: for padded windows the padding is ``width - p_i + p_j``, so the best ``j`` is the
minimum of ``f(j) + p_j`` over a sliding window, which a monotone queue gives in constant
time; the windows with a power of two of tokens are looked up exactly. Every
``FORCED_STEP``-th token is a candidate too, for sentences longer than a window and for
full windows where the nearest sentence end would cost more padding than the cut.

The stream is solved in blocks of about ``BLOCK`` tokens that end with a document, so a
task holds one block (or one longer document). Sequence ids are made of the partition's
number and a running number: a task that runs again gives the same ids.

Cases: a null text counts as empty; an empty document is its separator alone. A null id
stays null. Repeated rows are packed as often as they occur. An empty table gives an
empty result. Other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import steps, text_bytes
from gatekit.llm.tokens import BatchEncoder, encoder

WIDTH = 1024
SEPARATOR = 0
SENTENCE_CUT = 2
FORCED_CUT = 12
FORCED_STEP = 256
BLOCK = 1 << 20
#: Windows shorter than this are not sought for being a power of two.
LEAST_POWER = 512
_ENDS = (b".", b"!", b"?", b"\n", "。".encode(), "！".encode(), "？".encode())


def sentence_ends(enc: BatchEncoder) -> np.ndarray:
    """For each id whether its token ends a sentence."""
    return np.array([t.endswith(_ENDS) for t in enc.token_bytes], bool)


def best_cuts(total: int, doc_ends: np.ndarray, sentence: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The ends of the windows of a stream of ``total`` tokens; the last is ``total``."""
    if total == 0:
        return np.zeros(0, np.int64)
    soft = np.union1d(sentence[(sentence > 0) & (sentence < total)], doc_ends)
    step = min(FORCED_STEP, width)
    points = np.union1d(np.concatenate([[0], soft]), np.arange(step, total, step))
    penalty = np.full(len(points), FORCED_CUT)
    penalty[np.isin(points, soft)] = SENTENCE_CUT
    penalty[np.isin(points, doc_ends)] = 0
    # windows of exactly 2**k tokens: (i, j) with p_i - p_j = 2**k
    exact: dict[int, list[int]] = {}
    power = LEAST_POWER if width > LEAST_POWER else 1
    while power <= width:
        j = np.searchsorted(points, points - power)
        hit = np.flatnonzero((points >= power) & (points[np.minimum(j, len(points) - 1)] == points - power))
        for i, b in zip(hit.tolist(), j[hit].tolist()):
            exact.setdefault(i, []).append(b)
        power *= 2
    p, pen = points.tolist(), penalty.tolist()
    n = len(p)
    f, g, back = [0] * n, [0] * n, [0] * n  # g = f + p, what the queue minimises
    queue, head, tail = [0] * n, 0, 1
    for i in range(1, n):
        low = p[i] - width
        while p[queue[head]] < low:
            head += 1
        b = queue[head]
        best = g[b] - low
        for j in exact.get(i, ()):
            if f[j] < best:
                best, b = f[j], j
        f[i] = best = best + pen[i]
        back[i] = b
        g[i] = best = best + p[i]
        while tail > head and g[queue[tail - 1]] >= best:
            tail -= 1
        queue[tail] = i
        tail += 1
    cuts, i = [], n - 1
    while i > 0:
        cuts.append(p[i])
        i = back[i]
    return np.array(cuts[::-1], np.int64)


def _pieces(ids: np.ndarray, lengths: np.ndarray, ends_sentence: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """The pieces of a block: window and document meet."""
    doc_end = np.cumsum(lengths)
    total = int(doc_end[-1]) if len(doc_end) else 0
    cuts = best_cuts(total, doc_end, np.flatnonzero(ends_sentence[ids]) + 1, width)
    ends = np.union1d(doc_end, cuts)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    doc = np.searchsorted(doc_end, starts, side="right")
    window = np.searchsorted(cuts, starts, side="right")
    little = np.ascontiguousarray(ids, "<u4")
    raw = memoryview(little).cast("B")
    crc = np.fromiter((zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(ends))
    return {"doc": doc, "start": starts - (doc_end - lengths)[doc], "length": ends - starts, "ids_crc32": crc,
            "doc_tokens": lengths[doc], "window": window, "offset": starts - np.concatenate([[0], cuts])[window]}


def _packer(path: str, width: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        ends = sentence_ends(enc)
        ends[SEPARATOR] = True
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 40
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size, windows = 0, 0

        def solve() -> pa.RecordBatch:
            nonlocal windows, size
            key = pa.concat_arrays([h[0] for h in held])
            ids, lengths = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            out = _pieces(ids, lengths, ends, width)
            cols = [key.take(pa.array(out["doc"])), *(pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens")),
                    pa.array(base + windows + out["window"], pa.int64()), pa.array(out["offset"], pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                at = np.concatenate([[0], np.cumsum(out["length"])]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32))))
                names.append("ids")
            windows += int(out["window"].max()) + 1
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(cols, names=names)

        for b in batches:
            data, offs = text_bytes(b.column(1))
            for i, j in steps(offs):
                ids, count = enc.encode(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                ids = np.insert(ids, np.cumsum(count), np.uint32(SEPARATOR))
                held.append((b.column(0).slice(i, j - i), ids, count + 1))
                size += len(ids)
                if size >= BLOCK:
                    yield solve()
        if held:
            yield solve()
    return run


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", width: int = WIDTH, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length,
    ids_crc32, doc_tokens, sequence_id, offset in the sequence; ``with_ids`` adds the
    ids. The pieces of a sequence, by offset, are its content."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(_packer(tokenizer, width, with_ids), schema + (", ids array<int>" if with_ids else ""))
