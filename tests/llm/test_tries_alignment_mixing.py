"""Prefix trie, cross-tokenizer alignment and mixing against brute force, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from gatekit.llm import alignment, mixing, prefix_trie, tokens
from gatekit.llm.common import prepare
from gatekit.llm.double_array import DoubleArray
from gatekit.llm.perfect_hash import PerfectHash

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TURNS = "conv_id long, turn int, role string, text string, depth int, n long, x1 string, `a.b` int"
DOCS = "doc_id long, text string, source string, size int, step string, words int, target string, part int, pos int, `a.b` int"


# ---------------------------------------------------------------- prefix trie
def rebuilt(rows):
    own = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), (r or "", x or "")))
    own = {c: [x for _, x in sorted(v, key=lambda z: z[0])] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: tuple(own.get(c - c % 100, [])[:h[c]]) + tuple(v[h[c]:]) for c, v in own.items()}


def brute_nodes(rows):
    built, members = rebuilt(rows), collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()]


def by_value(rows):
    return sorted([tuple(r) for r in rows], key=lambda r: [(x is None, x or 0) for x in r])


def conversations(n, longest, seed):
    rng = random.Random(seed)
    texts = ["", None, "hi", "yo", "é😀", "a", "b", "c"]
    plans = [[(rng.choice(["u", None, "a"]), rng.choice(texts)) for _ in range(longest)] for _ in range(3)]
    rows = []
    for c in rng.sample(range(700), n):
        own = list(rng.choice(plans)[:rng.randrange(1, longest + 1)])
        if rng.random() < 0.5:
            own[rng.randrange(len(own))] = ("z", rng.choice(texts))
        rows += [(c, None if i == 0 and rng.random() < 0.3 else i, r, x, 7, 8, "x", 9) for i, (r, x) in enumerate(own)]
    return rows + [(None, 1, "u", "x", 1, 1, "", 1)] + [(800, 3, "u", "same", 0, 0, "", 0)] * 3  # a null id, repeated rows


@pytest.mark.parametrize("segment, shared, shard_turns, longest", [(1024, 256, 4096, 8), (3, 2, 5, 11), (1, 1, 3, 5)])
def test_prefix_trie(spark, monkeypatch, segment, shared, shard_turns, longest):
    for k, v in (("SEGMENT", segment), ("SHARED", shared), ("SHARD_TURNS", shard_turns)):
        monkeypatch.setattr(prefix_trie, k, v)
    rows = conversations(60, longest, segment)
    df = prepare(spark).createDataFrame(rows, TURNS).repartition(4)
    assert by_value(prefix_trie.trie(df).collect()) == by_value(brute_nodes(rows))


def test_prefix_trie_of_nothing_and_of_turnless_conversations(spark):
    prepare(spark)
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).collect() == []
    turnless = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 > 0)  # its head is absent
    rows = [(turnless, 0, "u", "gone", 0, 0, "", 0)]
    got = prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()
    assert by_value(got) == by_value(brute_nodes(rows)) and len(got) == 1 and got[0].n_leaves == 1


def test_double_array():
    rng = random.Random(4)
    seqs = [[rng.randrange(12) for _ in range(rng.randrange(7))] for _ in range(400)]
    trie = DoubleArray.build(seqs)
    nodes = {tuple(s[:d]) for s in seqs for d in range(len(s) + 1)}
    seen = {}
    for p in nodes:
        state = np.zeros(1, np.int64)
        for c in p:
            state = trie.step(state, np.array([c]))
        assert state[0] >= 0
        seen[p] = int(state[0])
    assert len(set(seen.values())) == len(nodes)
    for p in nodes:  # nothing beside them
        for c in range(14):
            there = trie.step(np.array([seen[p]]), np.array([c]))[0]
            assert (there >= 0) == ((*p, c) in nodes)


# ---------------------------------------------------------------- alignment
def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 50_000))
    ph = PerfectHash.load(PerfectHash.build(keys).dump())
    assert sorted(ph.find(keys).tolist()) == list(range(len(keys)))
    assert (ph.find(np.setdiff1d(rng.integers(0, 1 << 40, 5000), keys)) == -1).all()
    assert PerfectHash.build(keys[:0]).find(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([3, 3]))


ALIGNER = alignment.Aligner(A, B)
HF = Tokenizer.from_file(A)
HF.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=B)


def whole(text):
    """(ids of A, ids of B, links, groups) by the libraries on the whole text."""
    if not text:
        return None
    a, b, raw = HF.encode(" " + text, add_special_tokens=False).ids, SP.encode(text), (" " + text).encode()
    ab, bb = [ALIGNER.a_bytes[i] for i in a], [ALIGNER.b_bytes[i] for i in b]
    if b"".join(ab) != raw or b"".join(bb) != raw:
        return None
    ae, be = np.cumsum([len(x) for x in ab]), np.cumsum([len(x) for x in bb])
    ends = sorted({*ae.tolist(), *be.tolist()})
    links = [(a[int(np.searchsorted(ae, e))], b[int(np.searchsorted(be, e))]) for e in ends]
    groups, i, j = [], 0, 0
    for e in sorted({*ae.tolist()} & {*be.tolist()}):
        x, y = int(np.searchsorted(ae, e)) + 1, int(np.searchsorted(be, e)) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    return a, b, links, groups


def brute_alignment(rows):
    found = [(r[0], whole(r[1])) for r in rows]
    count = collections.Counter(p for _, w in found if w for p in w[2])
    best = collections.Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(i, len(w[0]), len(w[1]), len(w[3]), len(w[2]), sum(count[p] == best[p[1]] for p in w[2]), sum(count[p] for p in w[2]),
             hashlib.sha256(";".join(w[3]).encode()).hexdigest()) if w else (i, 0, 0, 0, 0, 0, 0, "") for i, w in found]


def odd_texts(n, seed):
    rng = random.Random(seed)
    parts = list("ab é \n\t\r　 \x1c\x85ñ’'s漢😀012.!") + ["<|endoftext|>", " the", " and", "\n\n", "ing", "\r\n", " </s>", "<0x0A>", "▁", "<s>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_chunks_equal_whole_texts():
    texts = odd_texts(1500, 2) + ["x" * 3000, " " * 3000 + "a", "a" + "\n" * 2500, "é " * 800]
    for i in range(0, len(texts), 100):
        for t, x in zip(texts[i:i + 100], ALIGNER.numbers([t.encode() for t in texts[i:i + 100]])):
            w = whole(t)
            assert (x is None) == (w is None), t
            if w:
                codes = [c for k in x for c in ALIGNER.codes[ALIGNER.first[k]:ALIGNER.first[k + 1]].tolist()]
                assert b";".join(ALIGNER.text[k] for k in x).decode() == ";".join(w[3])
                assert codes == [p * ALIGNER.b_size + q for p, q in w[2]]
                assert ALIGNER.shape[x].sum(axis=0).tolist()[:3] == [len(w[0]), len(w[1]), len(w[3])]


@pytest.mark.parametrize("limit, fan", [(None, 16), (40, 2), (0, 3)])
def test_alignment(spark, monkeypatch, limit, fan):
    monkeypatch.setattr(alignment, "FAN", fan)
    monkeypatch.setattr(alignment, "MEMO_LINKS", 200 if fan == 2 else 1 << 20)
    texts = odd_texts(60, 3) + [None, "", "▁", "plain words and the same words", "plain words and the same words"]
    rows = [(None if i % 9 == 0 else i // 2, t, "s", 1, "x", 2, "y", 3, 4, 5) for i, t in enumerate(texts)]
    df = prepare(spark).createDataFrame(rows, DOCS).repartition(5)
    assert by_value(alignment.align(df, A, B, sent_pairs=limit).collect()) == by_value(brute_alignment(rows))
    assert alignment.align(df.limit(0), A, B).collect() == []


def test_alignment_reads_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    def text(i):
        read.add(1)
        return None if i == 3 else f"plain words and number {i // 2}"
    rows = [(i, None if i == 3 else f"plain words and number {i // 2}") for i in range(20)]
    df = prepare(spark).range(20).select(F.col("id").alias("doc_id"), F.udf(text, "string")("id").alias("text"))
    assert by_value(alignment.align(df, A, B, sent_pairs=10).collect()) == by_value(brute_alignment(rows))
    assert read.value == 20


def test_long_runs_of_white_space():
    enc = tokens.BatchEncoder(tokens.file_ranks(A))
    for c in " \t\n　":
        n = 2_000_000 if c in " \n" else 400_000
        for text in ("a" + c * n + "b", "a" + c * n, c * n + " b"):
            raw = text.encode()
            ids, counts = enc.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            assert counts.tolist() == [len(ids)] and b"".join(enc.token_bytes[i] for i in ids.tolist()) == raw
    rng = random.Random(6)  # cut by the rule, and not cut
    for _ in range(300):
        text = "".join(rng.choice(["a", " b", ".", *[rng.choice(" \t\n\x85　") * rng.randrange(1, 9)] * 3]) for _ in range(12))
        whole_ids = enc.encoding.encode_ordinary(text)
        run, tokens._RUNS, tokens.LONG_RUN = (tokens._RUNS, tokens.LONG_RUN), re.compile(tokens._RUNS.pattern.replace("{1000,}", "{3,}")), 1
        assert enc.text_ids(text) == whole_ids
        tokens._RUNS, tokens.LONG_RUN = run


# ---------------------------------------------------------------- mixing
def targets(sizes):
    """By the textbook loop."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free -= over
        left -= sum(out[s] for s in over)
    return out


def test_mixing(spark):
    rng = random.Random(8)
    words = lambda n: " ".join(rng.choice(["é", "ab", "x\t\n"]) for _ in range(n))
    rows = [(i, rng.choice([None, "", "   ", words(rng.randrange(400)), words(rng.randrange(40))]), rng.choice(["b", "a", "é", "z", None, "hot", "hot", "hot", "B"])) for i in range(700)]
    rows += [(5000, "one two", "tiny"), (5001, "", "none"), (None, words(900), "hot")] + [(7, "again and again", "b")] * 50
    df = prepare(spark).createDataFrame([(*r, 1, "x", 2, "y", 3, 4, 5) for r in rows], DOCS)
    got = mixing.mix(df.repartition(6)).drop("repeats").collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(3)).drop("repeats").collect()))
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    size_of = collections.Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), sizes[s], round(want[s], 6)) for i, t, s in rows)
    assert collections.Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == size_of
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[(r.source_size, round(r.target, 6))] += r.taken
    for s, n in sizes.items():
        same = [x for x in sizes if (sizes[x], round(want[x], 6)) == (n, round(want[s], 6))]
        assert abs(taken[(n, round(want[s], 6))] - len(same) * want[s]) <= 60 * len(same)
    assert mixing.mix(df.limit(0)).collect() == []
    assert len(mixing.mix(df, seed=1).filter("taken > 0").collect()) > 0
