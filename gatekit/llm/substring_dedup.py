"""Repeated passages: hashed seeds and lines, grouped globally, all but the first removed.

A line is normalised (A-Z lowered, white space collapsed). Two things of a text are hashed:
its lines, and seeds of ``SEED`` words. Of each ``WINDOW`` neighbouring places that a seed
can begin at, the one of the least hash gives a seed (winnowing), so every run of
``SEED + WINDOW - 1`` (39) words that two texts share, lines or not, has a seed in both at
the same words. The 128-bit digests are grouped over the corpus; the occurrence with the
lowest rank (document id, place in the text) stays, the others are repeats. Only digests,
ids and places are shuffled. What is removed:

- the words of repeated seeds, extended word by word at each end of a run of them as far as
  the words of the end's first occurrence agree, and
- runs of neighbouring repeated lines with ``MIN_LINE`` (20) words or more together; shorter
  lines stay, however often they occur.

An end is extended by fewer than ``WINDOW`` words, as there would be one more seed
otherwise; the first occurrences hand on that many hashes of words. The words of a repeat
stand at a lower rank too, so no wording disappears from the corpus; where a seed repeats
one of the same text with which it overlaps, the first one's words stay. Shared runs of 20
to 38 words are found if they hold a seed. The spans keep their offsets (code points) in
the original text.

Cases: null and blank texts have no seeds. Rows equal in id and text are one document and
get equal results; of different texts that share an id, seeds in the same place keep
equal ranks, so neither is a repeat of the other. Rows with a null id rank first. An empty table gives an empty result.
Other columns are passed through (``dedup_documents``) or ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatekit.llm.common import plain_names, steps, stored, text_bytes
from gatekit.llm.textops import U, _BASE, _INVERSE, _pow, mix, words

SEED = 20
WINDOW = 20
#: Words of a run of repeated lines that is removed: as many as a seed has, so ordinary short
#: sentences and notices stay.
MIN_LINE = 20
_PLACE = U((1 << 28) - 1)  # bits of a place beside the hash it is chosen by
#: Ids that a join may broadcast after counting them.
BROADCAST_ROWS = 500_000


def _digest(h: np.ndarray, s: np.ndarray, e: np.ndarray, salt: int) -> np.ndarray:
    total = np.zeros(len(h) + 1, U)
    np.cumsum(mix(h ^ U(salt)) * _pow(_BASE, len(h)), out=total[1:])
    return mix((total[e] - total[s]) * _pow(_INVERSE, len(h) + 1)[s] + (e - s).astype(U)).astype(np.int64)


def _opens(data: np.ndarray, w) -> np.ndarray:
    """Whether a word is the first one of its line (or text)."""
    doc, opens = w.doc, np.ones(len(w.hash), bool)
    if len(opens):
        line = np.cumsum(data == 10)[w.start]
        opens[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    return opens


def seed_places(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where seeds begin: of ``WINDOW`` neighbouring places in a text (or all, if there are
    fewer) the last one of the least hash. ``ends`` has the end of each word's text."""
    n = len(h)
    at = np.arange(n)
    own = at + SEED <= ends  # a seed fits
    key = np.full(n + WINDOW, ~U(0))
    key[:n][own] = (h[own] & ~_PLACE) | (_PLACE - at[own].astype(U))
    least, width = key, 1
    while 2 * width <= WINDOW:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:n], least[WINDOW - width:WINDOW - width + n])
    begins = np.ones(n, bool)
    begins[1:] = ends[1:] != ends[:-1]
    whole = own & ((at + WINDOW - 1 + SEED <= ends) | begins)  # a text's first window may be short
    return np.unique((_PLACE - (least[whole] & _PLACE)).astype(np.int64))


def marks(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The seeds and lines of each document of a step: document, unit (twice the number of
    the first word, and one more for a line), digest."""
    w = words(data, offsets, lower=True)
    doc, n = w.doc, len(w.hash)
    s = np.flatnonzero(_opens(data, w))
    e = np.append(s[1:], n)[:len(s)]
    ends = w.first[1:][doc]
    at = np.arange(max(n - SEED + 1, 0))
    h = np.zeros(n, U)
    h[at] = _digest(w.hash, at, at + SEED, 0x2545F4914F6CDD1D).view(U)
    p = seed_places(h, ends)
    of = np.concatenate([p, s])
    unit = 2 * (of - w.first[doc[of]])
    unit[len(p):] += 1
    lines = [_digest(w.hash, s, e, salt) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return {"doc": doc[of], "unit": unit, "h1": np.concatenate([h[p].view(np.int64), lines[0]]),
            "h2": np.concatenate([_digest(w.hash, p, p + SEED, 0x369DEA0F31A53F85), lines[1]])}


def _mark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offs = text_bytes(b.column(2))
        for i, j in steps(offs):
            u = marks(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            at = pa.array(u["doc"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i).take(at), b.column(1).slice(i, j - i).take(at), pa.array(u["unit"], pa.int32()), pa.array(u["h1"]), pa.array(u["h2"])],
                names=["doc_id", "print", "unit", "h1", "h2"])


def _text_words(text: str):
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    return data, words(data, np.array([0, len(raw)]), lower=True)


_AROUND = T.ArrayType(T.StructType([T.StructField("unit", T.IntegerType()), T.StructField("before", T.BinaryType()), T.StructField("after", T.BinaryType())]))
_ARROW_AROUND = pa.list_(pa.struct([("unit", pa.int32()), ("before", pa.binary()), ("after", pa.binary())]))


@F.arrow_udf(_AROUND)
def _around(text: pa.Array, units: pa.Array) -> pa.Array:
    """The hashes of the words before (the nearest first) and after seeds."""
    out = []
    for t, us in zip(text, units):
        h = _text_words(t.as_py())[1].hash
        out.append([{"unit": u, "before": h[max(u // 2 - WINDOW + 1, 0):u // 2][::-1].tobytes(), "after": h[u // 2 + SEED:u // 2 + SEED + WINDOW - 1].tobytes()} for u in us.as_py()])
    return pa.array(out, _ARROW_AROUND)


def _agree(a: np.ndarray, raw: bytes) -> int:
    b = np.frombuffer(raw, U)
    n = min(len(a), len(b))
    return int(np.append(a[:n] == b[:n], False).argmin())


def removed_spans(text: str, units: np.ndarray, sources: np.ndarray, edges: dict[int, tuple[bytes, bytes]]) -> list[tuple[int, int]]:
    """The spans to remove, given a document's repeated units, the place of the first
    occurrence where that lies in the same document (else -1), and the hashes of the words
    before and after the first occurrence of those at the end of a run."""
    data, w = _text_words(text)
    n, own = len(w.hash), dict(zip(units.tolist(), sources.tolist()))
    opens = _opens(data, w)
    gone = np.zeros(n, bool)
    for u, source in own.items():
        if u % 2 == 0:
            s, e = u // 2, u // 2 + SEED
            if u in edges:
                s, e = s - _agree(w.hash[:s][::-1], edges[u][0]), e + _agree(w.hash[e:], edges[u][1])
            if source >= 0:
                s = max(s, source // 2 + SEED)
            gone[s:e] = True
    starts = np.append(np.flatnonzero(opens), n).tolist()
    again = [2 * s + 1 in own for s in starts[:-1]]
    i = 0
    while i < len(again):
        j = i
        while j < len(again) and again[j]:
            j += 1
        if starts[j] - starts[i] >= MIN_LINE:
            gone[starts[i]:starts[j]] = True
        i = j + 1
    points = np.cumsum(np.append((data & 0xC0) != 0x80, True)) - 1
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    out = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        stop = (w.start[b] if b < n else len(data)) if opens[a] else w.end[b - 1]
        out.append((int(points[w.start[a]]), int(points[stop])))
    return out


_CUT = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))), T.StructField("rest", T.StringType())])
_ARROW_CUT = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("rest", pa.string())])


@F.arrow_udf(_CUT)
def _cut(text: pa.Array, units: pa.Array, sources: pa.Array, ends: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
    """The spans to remove and what they leave of a text (null if there are none). One
    function, so a task needs one Python worker."""
    out = []
    for row in zip(text, units, sources, ends, before, after):
        t, u, s, e, b, a = (x.as_py() for x in row)
        edges = {} if e is None else {k: v for k, *v in zip(e, b, a)}
        spans = removed_spans(t, np.array(u, np.int64), np.array(s, np.int64), edges) if t is not None and u else []
        at = [0, *(x for span in spans for x in span), None]
        rest = "".join([t[x:y] for x, y in zip(at[::2], at[1::2])]) if spans else None
        out.append({"spans": [{"start": x, "end": y} for x, y in spans], "rest": rest})
    return pa.array(out, _ARROW_CUT)


def _edges(seeds: str) -> Column:
    """Of a sorted array of repeated seeds those at an end of a run."""
    far = f"coalesce(x.unit - get({seeds}, i - 1).unit > {2 * SEED}, true) OR coalesce(get({seeds}, i + 1).unit - x.unit > {2 * SEED}, true)"
    return F.expr(f"filter({seeds}, (x, i) -> {far})")


def repeated_units(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print, repeats, sources, ends, before, after) of the documents with
    repeated seeds and lines: these by their number, the place of the first occurrence
    where that is in the same text (else -1), and the seeds at the ends of runs with the
    hashes of the words around their first occurrence; ``print`` is the hash of the text,
    which tells apart rows that share an id."""
    rows = docs.select(F.col(id).alias("doc_id"), F.xxhash64(F.col(text)).alias("print"), F.col(text).alias("__text"))
    u = rows.mapInArrow(_mark_rows, f"doc_id {rows.schema[0].dataType.simpleString()}, print long, unit int, h1 long, h2 long")
    firsts = u.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "unit", "print")).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    # stored, so that it is dealt out for the join by itself and Spark can split a common digest's rows
    firsts = stored(firsts.select("h1", "h2", "first"), "firsts")
    again = u.join(firsts, ["h1", "h2"]).filter(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("unit") == F.col("first.unit"))))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("print") == F.col("first.print"))
    line, seed = F.col("unit") % 2 == 1, F.struct("unit", F.when(same, F.col("first.unit")).otherwise(-1).alias("source"), "first")
    own = again.groupBy("doc_id", "print").agg(F.collect_set(F.when(line, F.col("unit"))).alias("lines"), F.array_sort(F.collect_set(F.when(~line, seed))).alias("seeds"))
    own = stored(own, "repeats").select(
        "doc_id", "print", F.concat("lines", "seeds.unit").alias("repeats"),
        F.concat(F.array_repeat(F.lit(-1), F.size("lines")), F.col("seeds.source")).alias("sources"), _edges("seeds").alias("edges"))
    asked = own.select("doc_id", "print", F.explode("edges").alias("e")).select(
        "doc_id", "print", F.col("e.unit").alias("unit"), F.col("e.first.doc_id").alias("__id"), F.col("e.first.print").alias("__print"), F.col("e.first.unit").alias("__unit"))
    wanted = stored(asked.groupBy("__id", "__print").agg(F.collect_set("__unit").alias("__units")), "first-texts")
    if wanted.count() <= BROADCAST_ROWS:
        some = rows.join(F.broadcast(wanted.select("__id", "__print")), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("print") == F.col("__print")), "left_semi")
    else:
        some = rows
    told = some.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("print") == F.col("__print"))).select("__id", "__print", F.explode(_around("__text", "__units")).alias("a"))
    told = told.select(F.col("__id").alias("__tid"), F.col("__print").alias("__tprint"), F.col("a.unit").alias("__tunit"), "a.before", "a.after").dropDuplicates(["__tid", "__tprint", "__tunit"])
    known = asked.join(told, F.col("__id").eqNullSafe(F.col("__tid")) & (F.col("__print") == F.col("__tprint")) & (F.col("__unit") == F.col("__tunit")))
    known = known.groupBy(F.col("doc_id").alias("__kid"), F.col("print").alias("__kprint")).agg(F.collect_list(F.struct("unit", "before", "after")).alias("k"))
    j = own.drop("edges").join(known, F.col("doc_id").eqNullSafe(F.col("__kid")) & (F.col("print") == F.col("__kprint")), "left")
    return j.select("doc_id", "print", "repeats", "sources", F.col("k.unit").alias("ends"), F.col("k.before").alias("before"), F.col("k.after").alias("after"))


@plain_names("id", "text")
def dedup_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without repeats: the columns of ``docs``, the text shortened, and
    ``__removed``, the spans cut out (empty where nothing was)."""
    facts = ["repeats", "sources", "ends", "before", "after"]
    own = repeated_units(docs, id, text).select(F.col("doc_id").alias("__id"), F.col("print").alias("__print"), *(F.col(c).alias(f"__{c}") for c in facts))
    j = docs.join(own, F.col(id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__print")), "left")
    asked = F.when(F.col("__repeats").isNotNull(), F.col(text))  # other texts are not sent to Python
    j = j.select(*(F.col(f"`{c}`") for c in docs.columns), _cut(asked, *(F.col(f"__{c}") for c in facts)).alias("__cut"))
    return j.select(*(F.coalesce("__cut.rest", F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns), F.col("__cut.spans").alias("__removed"))
