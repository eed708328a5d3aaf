"""Cross-tokenizer alignment: how the tokens of two vocabularies lie over each other.

Tokenizer A is a byte-level BPE file, B a sentencepiece model; both see a blank and then
the text. Byte offsets where tokens of both end cut the text into groups; a token of A and
one of B are linked where their byte ranges overlap. The counts of linked pairs over the
whole corpus come in two passes:

1. Each task aligns its documents, stores the links of each and keeps a count per distinct
   pair of ids. The pairs are split by their B id into shards. Per shard the distinct pairs
   get a minimal perfect hash; the tasks' counts become dense vectors under it, which are
   summed in a tree of fan-in ``FAN``. A pair without a verified key stops the job.
2. The counts of the stored links are looked up; no text is aligned twice. The most
   frequent pairs, at most ``SENT_PAIRS`` of them, go to every task as one more perfect
   hash; pairs that it does not hold are asked of their shards, so no count is left out.

A shard holds all pairs of its B ids, so it also knows which count is the highest of a B
id. Its size is bounded by the two vocabularies, not by the corpus.

No token of either vocabulary runs over a blank or line feed that follows a character
other than white space (A by its split pattern; B is asked for its pieces, and texts are
not cut where one would). So texts are aligned chunk by chunk between such places, and
each distinct chunk once; a worker forgets its chunks when they hold ``MEMO_LINKS``.

Cases: a text that is null, empty, not UTF-8, or that one of the vocabularies does not
give back byte by byte has no tokens: zeros and an empty ``groups_sha256``, and it adds
nothing to the counts. Special tokens' strings are plain text. Texts of any length are
aligned whole. A null or repeated id is a row like others; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import steps, stored, text_bytes
from gatekit.llm.perfect_hash import PerfectHash
from gatekit.llm.tokens import encoder

#: Shards of the pairs, by B id.
SHARDS = 128
#: Vectors that one step of the tree adds up.
FAN = 16
#: Pairs that are sent to every task (17 bytes and 4 bits each).
SENT_PAIRS = 1 << 20
#: Links of distinct chunks that a worker remembers.
MEMO_LINKS = 2 << 20
#: Rows that one group asks of a shard.
ASKED = 1 << 20
#: Links that are looked up at once.
STEP_LINKS = 1 << 18

_BLANK = "▁"


class _Memo(dict):
    """Chunk -> number, in the order in which chunks are met; ``new`` are to be aligned."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        self.new.append(chunk)
        return n


class Aligner:
    """Groups and links of texts, chunk by chunk. ``codes`` holds the links of the chunks
    in a row: A id * ``b_size`` + B id; ``first`` where those of a chunk begin; ``shape``
    its tokens of A and of B, its groups, and whether both give it back; ``text`` its groups."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        self.a_bytes, self.a_len = self.a.token_bytes, self.a.size
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # where B may be cut: no piece has the character behind another one
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        blanks = not any(_BLANK in p.lstrip(_BLANK) for p in plain)
        lines = blanks and not any("\n" in p for p in plain)
        self.blank_id = self.b.piece_to_id(_BLANK)
        #: What a stored link takes.
        self.link_type = np.dtype(np.int32 if len(self.a_len) * self.b_size <= 1 << 31 else np.int64)
        last = "[^\\S \n]" if lines else "[^\\S ]"
        self.cut = re.compile(rf"\s*\S+(?:{last}\s*\S+)*(?:{last}\s*$)?|\s+").findall if blanks else lambda text: [text]
        self.forget()

    def forget(self) -> None:
        self.memo = _Memo()
        self.codes, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.shape = np.zeros((0, 4), np.int64)
        self.text: list[bytes] = []

    def full(self) -> bool:
        return len(self.codes) > MEMO_LINKS

    def _b_ids(self, chunks: list[str]) -> list[list[int]]:
        """The model puts a blank before the text itself."""
        own = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [[self.blank_id] if c == " " else x if c[0] == " " else x[1:] for c, x in zip(chunks, own)]

    def _given_back(self, chunk: str, a: list[int], b: list[int]) -> bool:
        raw = chunk.encode()
        return b"".join([self.a_bytes[i] for i in a]) == raw and b"".join([self.b_bytes[i] for i in b]) == raw

    def learn(self) -> None:
        """Align the chunks that were met for the first time, all at once: they stand
        behind each other, and both vocabularies have an end between any two."""
        chunks, self.memo.new = self.memo.new, []
        if not chunks:
            return
        # a chunk with white space at its end would run into the next one
        loose = [c[-1].isspace() for c in chunks]
        joined = "".join([c for c, x in zip(chunks, loose) if not x])
        a_own = {k: self.a.text_ids(c) for k, (c, x) in enumerate(zip(chunks, loose)) if x}
        got = np.array(self.a.text_ids(joined), np.int64)
        size = np.array([len(c.encode()) for c in chunks], np.int64)
        tight = ~np.array(loose)
        upto = np.zeros(len(chunks) + 1, np.int64)
        count = np.zeros(len(chunks), np.int64)
        till = np.searchsorted(np.cumsum(self.a_len[got]), np.cumsum(size[tight]), side="left") + 1
        count[tight] = np.diff(till, prepend=0)
        for k, ids in a_own.items():
            count[k] = len(ids)
        np.cumsum(count, out=upto[1:])
        a = np.empty(upto[-1], np.int64)
        a[np.repeat(tight, count)] = got
        for k, ids in a_own.items():
            a[upto[k]:upto[k + 1]] = ids
        b_own = self._b_ids(chunks)
        b_count = np.fromiter(map(len, b_own), np.int64, len(b_own))
        b = np.fromiter(chain.from_iterable(b_own), np.int64, int(b_count.sum()))
        good = np.ones(len(chunks), bool)
        raw = "".join(chunks).encode()
        b_size = np.add.reduceat(np.append(self.b_len[b], 0), np.append(0, np.cumsum(b_count)[:-1])) * (b_count > 0)
        if not (np.array_equal(b_size, size) and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == raw and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw):
            good = np.array([self._given_back(c, a[upto[k]:upto[k + 1]].tolist(), x) for k, (c, x) in enumerate(zip(chunks, b_own))])
            a, b = a[np.repeat(good, count)], b[np.repeat(good, b_count)]
        size, count, b_count = size * good, count * good, b_count * good
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        end = np.union1d(a_end, b_end)
        codes = a[np.searchsorted(a_end, end)] * self.b_size + b[np.searchsorted(b_end, end)]
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        last = np.cumsum(size)
        groups = np.diff(np.searchsorted(both, last, side="right"), prepend=0)
        text, text_end = self._group_text(a, b, np.searchsorted(both, a_end), np.searchsorted(both, b_end))
        stop = np.append(0, text_end)[np.cumsum(groups)].tolist()
        self.text += [text[x:max(x, y - 1)] for x, y in zip([0, *stop], stop)]
        self.codes = np.concatenate([self.codes, codes])
        self.first = np.concatenate([self.first, self.first[-1] + np.searchsorted(end, last, side="right")])
        self.shape = np.concatenate([self.shape, np.stack([count, b_count, groups, good], axis=1)])

    @staticmethod
    def _group_text(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;`` of all groups in a row, and where each group ends there."""
        ids, group = np.concatenate([a, b]), np.concatenate([a_group, b_group])
        kind = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((kind, group))
        ids, group, kind = ids[order], group[order], kind[order]
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        next_kind, next_group = np.append(kind[1:], 0), np.append(group[1:], -1)
        mark = np.where(next_group != group, ord(";"), np.where(next_kind != kind, ord("|"), ord(",")))
        width = len(str(int(ids.max())))
        digits = np.empty((len(ids), width + 1), np.uint8)
        rest = ids
        for k in range(width - 1, -1, -1):
            digits[:, k] = rest % 10 + 48
            rest = rest // 10
        digits[:, width] = mark
        length = np.searchsorted(10 ** np.arange(1, width + 1), ids, side="right") + 2  # digits and mark
        length = np.minimum(length, width + 1)
        keep = np.arange(width, -1, -1)[None, :] < length[:, None]
        return digits[keep].tobytes(), np.cumsum(length)[next_group != group]

    def chunks(self, raw: bytes) -> list[int] | None:
        """The numbers of a text's chunks; None if it cannot have tokens."""
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            return None
        memo = self.memo
        return list(map(memo.__getitem__, self.cut(" " + text))) if text else None

    def numbers(self, texts: list[bytes]) -> list[np.ndarray | None]:
        """Per text the numbers of its chunks, which are aligned then; None: no tokens."""
        own = [self.chunks(t) for t in texts]
        self.learn()
        own = [None if x is None else np.array(x, np.int64) for x in own]
        good = self.shape[:, 3] == 1
        return [x if x is not None and good[x].all() else None for x in own]

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[np.ndarray | None]]]:
        """(batch, first row, chunk numbers per row) of bounded steps. The second column
        is the text. Numbers hold until chunks are forgotten."""
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in steps(offsets):
                yield batch, i, self.numbers([data[offsets[r]:offsets[r + 1]].tobytes() for r in range(i, j)])


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _ints(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.int64).tobytes()


def _from(raw: pa.Scalar) -> np.ndarray:
    return np.frombuffer(raw.as_py(), np.int64)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions starts[k] .. starts[k] + sizes[k] - 1 of all k in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


#: Of a document (``shard`` is null), or of a shard's pairs.
_FIRST = {"part": pa.int32(), "pos": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
          "groups_sha256": pa.string(), "links": pa.binary(), "shard": pa.int32(), "codes": pa.binary(), "counts": pa.binary()}


def first_pass(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Two kinds of rows. A document: its numbers, digest and links, by the part and place
    it has been read at. (shard, part, codes, counts): what a task has counted, as sorted
    int64 arrays; the others are null there."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        part, pos = TaskContext.get().partitionId(), 0
        times = np.zeros(0, np.int64)

        def rows(ids: pa.Array, n: int, have: dict) -> pa.RecordBatch:
            own = {"part": pa.array([part] * n, pa.int32()), **have}
            return pa.RecordBatch.from_arrays([ids, *(own[c] if c in own else pa.nulls(n, t) for c, t in _FIRST.items())], ["doc_id", *_FIRST])

        def flush() -> Iterator[pa.RecordBatch]:
            met = np.flatnonzero(times)
            sizes = np.diff(al.first)[met]
            codes, inverse = np.unique(al.codes[_spread(al.first[met], sizes)], return_inverse=True)
            counts = np.bincount(inverse, np.repeat(times[met], sizes), len(codes)).astype(np.int64)
            shard = codes % al.b_size % SHARDS
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(SHARDS + 1))
            out = [(s, _ints(codes[o]), _ints(counts[o])) for s in range(SHARDS) if len(o := order[cuts[s]:cuts[s + 1]])]
            if out:
                yield rows(pa.nulls(len(out), kind), len(out), {c: pa.array(x, _FIRST[c]) for c, x in zip(("shard", "codes", "counts"), zip(*out))})

        kind = pa.null()
        for batch, i, own in al.batches(batches):
            kind = batch.column(0).type
            n = len(own)
            met = np.concatenate([np.zeros(0, np.int64), *(x for x in own if x is not None)])
            if len(met):
                more = np.bincount(met, minlength=len(al.text))
                more[:len(times)] += times
                times = more
            upto = np.cumsum([0, *(0 if x is None else len(x) for x in own)])  # chunks before each document
            sizes = np.diff(al.first)[met]
            stop = np.append(0, np.cumsum(sizes))[upto]  # links before each document
            shape = np.diff(np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(al.shape[met], axis=0)])[upto], axis=0)
            links = al.codes[_spread(al.first[met], sizes)].astype(al.link_type)
            text = al.text
            digest = ["" if x is None else hashlib.sha256(b";".join([text[k] for k in x.tolist()])).hexdigest() for x in own]
            yield rows(batch.column(0).slice(i, n), n, {
                "pos": pa.array(np.arange(pos, pos + n)), "n_a": pa.array(shape[:, 0]), "n_b": pa.array(shape[:, 1]), "n_groups": pa.array(shape[:, 2]),
                "n_links": pa.array(np.diff(stop)), "groups_sha256": pa.array(digest, pa.string()),
                "links": pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((stop * al.link_type.itemsize).astype(np.int32)), pa.py_buffer(links)])})
            pos += n
            if al.full():
                yield from flush()
                al.forget()
                times = np.zeros(0, np.int64)
        yield from flush()
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(count, f"doc_id {key}, part int, pos long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, shard int, codes binary, counts binary")


def _unite(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    """The distinct codes of a group's rows, merged when they have doubled."""
    have, new, n = np.zeros(0, np.int64), [], 0
    for batch in batches:
        for raw in batch.column("codes"):
            new.append(_from(raw))
            n += len(new[-1])
            if n > max(1 << 20, len(have)):
                have, new, n = np.unique(np.concatenate([have, *new])), [], 0
    return np.unique(np.concatenate([have, *new]))


def hashes(counted: DataFrame, parts: int) -> DataFrame:
    """(shard, hash): a perfect hash over each shard's distinct codes, which are united in
    a tree over the parts."""
    def union(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"shard": [key[0].as_py()], "part": [key[1].as_py()], "codes": [_ints(_unite(batches))]}, pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("codes", pa.binary())]))

    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"shard": [key[0].as_py()], "hash": [PerfectHash.build(_unite(batches)).dump()]}, pa.schema([("shard", pa.int32()), ("hash", pa.binary())]))
    codes = counted.select("shard", "part", "codes")
    while parts > FAN:
        codes = codes.withColumn("part", F.expr(f"part div {FAN}").cast("int")).groupBy("shard", "part").applyInArrow(union, "shard int, part int, codes binary")
        parts = -(-parts // FAN)
    return codes.groupBy("shard").applyInArrow(build, "shard int, hash binary")


def summed(counted: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """(shard, counts): dense vectors in the order of the shard's perfect hash."""
    def dense(rows: pa.Table, hashed: pa.Table) -> pa.Table:
        ph = PerfectHash.load(hashed.column("hash")[0].as_py())
        total = np.zeros(len(ph.keys), np.int64)
        for codes, counts in zip(rows.column("codes"), rows.column("counts")):
            at = ph.find(_from(codes))
            if len(at) and at.min() < 0:
                raise ValueError("a pair is missing from its perfect hash")
            total[at] += _from(counts)
        return pa.table({"shard": hashed.column("s").slice(0, 1), "part": hashed.column("p").slice(0, 1), "counts": pa.array([_ints(total)], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for raw in batch.column("counts"):
                total = total + _from(raw)
        yield pa.RecordBatch.from_pydict({"shard": [key[0].as_py()], "part": [key[1].as_py()], "counts": [_ints(total)]}, pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())]))

    up = F.expr(f"part div {FAN}").cast("int").alias("part")
    rows = counted.select("shard", up, "codes", "counts")
    each = counted.select("shard", up).distinct().join(found, "shard").select(F.col("shard").alias("s"), F.col("part").alias("p"), "hash")
    schema = "shard int, part int, counts binary"
    out = rows.groupBy("shard", "part").cogroup(each.groupBy("s", "p")).applyInArrow(dense, schema)
    parts = -(-parts // FAN)
    while parts > 1:
        out = out.select("shard", up, "counts").groupBy("shard", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN)
    return out.select("shard", "counts")


def with_best(found: DataFrame, totals: DataFrame, b_size: int) -> DataFrame:
    """(shard, hash, counts, best): best is 1 where no pair of the same B id counts more."""
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, counts in zip(batch.column("hash"), batch.column("counts")):
                b, n = PerfectHash.load(raw.as_py()).keys % b_size, _from(counts)
                ids, which = np.unique(b, return_inverse=True)
                top = np.zeros(len(ids), np.int64)
                np.maximum.at(top, which, n)
                out.append((n == top[which]).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], ["shard", "hash", "counts", "best"])
    return found.join(totals, "shard").select("shard", "hash", "counts").mapInArrow(best, "shard int, hash binary, counts binary, best binary")


def _grade(counts: np.ndarray) -> np.ndarray:
    return np.floor(8 * np.log2(np.maximum(counts, 1))).astype(np.int64)


def sent(pairs: DataFrame, limit: int) -> tuple[bytes, bytes, bytes]:
    """(hash, counts, best) of the most frequent pairs, at most ``limit``: those above the
    lowest grade of counts from which on they fit."""
    def grades(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column("counts"):
                g, n = np.unique(_grade(_from(counts)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n.astype(np.int64))], ["grade", "n"])
    least, have = 1 << 20, 0
    for row in pairs.select("counts").mapInArrow(grades, "grade long, n long").groupBy("grade").agg(F.sum("n").alias("n")).orderBy(F.desc("grade")).collect():
        have += row.n
        if have > limit:
            break
        least = row.grade

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, counts, best in zip(*(batch.column(c) for c in ("hash", "counts", "best"))):
                n = _from(counts)
                at = np.flatnonzero(_grade(n) >= least)
                keys, top = PerfectHash.load(raw.as_py()).keys[at], np.frombuffer(best.as_py(), np.uint8)[at]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (_ints(keys), _ints(n[at]), top.tobytes())], ["keys", "counts", "best"])
    rows = pairs.mapInArrow(frequent, "keys binary, counts binary, best binary").collect()
    keys, counts = (np.frombuffer(b"".join(bytes(r[c]) for r in rows), np.int64) for c in ("keys", "counts"))
    top = np.frombuffer(b"".join(bytes(r["best"]) for r in rows), np.uint8)
    ph = PerfectHash.build(keys)
    at = np.argsort(ph.find(keys))
    return ph.dump(), _ints(counts[at]), top[at].tobytes()


_KNOWN = ["doc_id", "part", "pos", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def looked_up(rows: DataFrame, table, link_type: np.dtype) -> DataFrame:
    """The second pass: what each document of the first one has by the sent pairs, and the
    codes that they do not hold, with the document's links of each. ``table``: broadcast of
    :func:`sent`."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner.cache_clear()  # texts are not needed any more
        raw, counts, best = table.value
        ph, counts, best = PerfectHash.load(raw), np.frombuffer(counts, np.int64), np.frombuffer(best, np.uint8)
        for whole in batches:
            offsets = np.append(0, np.cumsum(whole.column("n_links").to_numpy()))
            for i, j in steps(offsets, STEP_LINKS):
                batch, upto = whole.slice(i, j - i), offsets[i:j + 1] - offsets[i]
                codes = np.frombuffer(b"".join(batch.column("links").to_pylist()), link_type)
                at = np.concatenate([np.zeros(0, np.int64), *(ph.find(codes[k:k + STEP_LINKS]) for k in range(0, len(codes), STEP_LINKS))])
                hit = at >= 0
                worth = np.zeros((2, len(codes) + 1), np.int64)  # sums over the links before each
                if len(counts):
                    np.cumsum(np.where(hit, best[at], 0), out=worth[0, 1:])
                    np.cumsum(np.where(hit, counts[at], 0), out=worth[1, 1:])
                top, total = np.diff(worth[:, upto], axis=1)
                miss = np.flatnonzero(~hit)
                cuts = np.searchsorted(miss, upto)
                none = np.zeros(0, np.int64)
                cold = [np.unique(codes[miss[a:b]], return_counts=True) if a < b else (none, none) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                lists = [pa.array([x[k] for x in cold], pa.list_(pa.int64())) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _KNOWN), pa.array(top), pa.array(total), *lists], [*_KNOWN, "n_best", "count_sum", "codes", "times"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, part int, pos long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, codes array<long>, times array<long>"
    return rows.select(*_KNOWN, "links").mapInArrow(look, schema)


def asked(rows: DataFrame, pairs: DataFrame, b_size: int) -> DataFrame:
    """(part, pos, best, total) of the codes that were not sent, asked of their shards in
    groups of about ``ASKED`` rows."""
    def answer(questions: pa.Table, shard: pa.Table) -> pa.Table:
        ph = PerfectHash.load(shard.column("hash")[0].as_py())
        counts, best = _from(shard.column("counts")[0]), np.frombuffer(shard.column("best")[0].as_py(), np.uint8)
        at = ph.find(questions.column("code").to_numpy())
        if len(at) and at.min() < 0:
            raise ValueError("a pair is missing from its perfect hash")
        n = questions.column("n").to_numpy()
        return pa.table({"part": questions.column("part"), "pos": questions.column("pos"), "best": pa.array(n * best[at]), "total": pa.array(n * counts[at])})
    many = rows.agg(F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()[0]
    salts = int(many // (ASKED * SHARDS)) + 1
    q = rows.filter(F.size("codes") > 0).select("part", "pos", F.explode(F.arrays_zip("codes", "times")).alias("x")).select(
        "part", "pos", F.col("x.codes").alias("code"), F.col("x.times").alias("n"), (F.col("x.codes") % b_size % SHARDS).cast("int").alias("shard"),
        F.pmod(F.xxhash64("part", "pos"), F.lit(salts)).cast("int").alias("salt"))
    each = q.select("shard", "salt").distinct().join(pairs, "shard").select(F.col("shard").alias("s"), F.col("salt").alias("t"), "hash", "counts", "best")
    got = q.groupBy("shard", "salt").cogroup(each.groupBy("s", "t")).applyInArrow(answer, "part int, pos long, best long, total long")
    return got.groupBy("part", "pos").agg(F.sum("best").alias("best"), F.sum("total").alias("total"))


def align(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", sent_pairs: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    al = aligner(a_path, b_path)
    b_size = al.b_size
    first = stored(first_pass(docs, a_path, b_path), "links")
    counted = first.filter("shard IS NOT NULL").select("shard", "part", "codes", "counts")
    parts = (counted.agg(F.max("part")).first()[0] or 0) + 1
    found = stored(hashes(counted, parts), "pair-hashes")
    pairs = stored(with_best(found, summed(counted, found, parts), b_size), "pairs")
    table = docs.sparkSession.sparkContext.broadcast(sent(pairs, SENT_PAIRS if sent_pairs is None else sent_pairs))
    rows = stored(looked_up(first.filter("shard IS NULL"), table, al.link_type), "aligned")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if rows.filter(F.size("codes") > 0).isEmpty():
        return rows.select(*columns)
    more = asked(rows, pairs, b_size)
    return rows.join(more, ["part", "pos"], "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("total", F.lit(0))}).select(*columns)
