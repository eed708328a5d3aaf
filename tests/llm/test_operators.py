"""Each operator against a brute-force version, with nulls, empty and long texts, ties,
repeated rows, empty tables and extra columns of clashing names."""
import base64
import collections
import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gatekit.llm import bpe, license_scan, packing, quality, setsketch, sharding, substring_dedup, toxicity, vecgraph, warc
from gatekit.llm.common import prepare
from gatekit.session import conf_for, scratch_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, __text int, n long, regs string, first int"
RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefghéñ") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", ".\n"]) for _ in range(n))


BASE = prose(120)
#: The near-duplicate contracts lower-case A to Z only.
ASCII_UPPER = "".join(c.upper() if c.isascii() else c for c in BASE)
PASSAGE = prose(60).replace("\n", " ")
TEXTS = [
    None, "", "   ", "one", "One two", BASE, BASE, ASCII_UPPER, BASE + " more words", prose(90) + " " + PASSAGE + " " + prose(80),
    prose(70) + " " + PASSAGE + " " + prose(90), "é " * 70, prose(6000), "x" * 5000, "a  b\t\tc  d　 e", prose(200), "la la la " * 40,
    "Intro\nReleased under the MIT License.\n" + prose(60), "**# $% & | <>\n" * 3 + prose(60),
    "hello <|endoftext|> world", "<|endoftext|><|endoftext|> a<|endoftext", "a" + " \n" * 4000 + "<|endoftext|>  b",
]
ROWS = [(i, t, "en", None if i % 5 == 0 else f"h{i % 3}") for i, t in enumerate(TEXTS)] + [(None, prose(55), "en", "h1"), (5, BASE, "en", "h2")]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, 2, 3, "x", 4) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


def words(t):
    return (t or "").encode().split()


def test_packing(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = collections.Counter()
    by_crc = {}
    for i, t, *_ in ROWS:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want[(i, len(ids))] += 1
        by_crc[(i, len(ids))] = ids
    got = packing.pack(docs, path, with_ids=True).collect()
    seqs, starts = collections.defaultdict(list), collections.Counter()
    for r in got:
        ids = by_crc[(r.doc_id, r.doc_tokens)][r.start:r.start + r.length]
        assert r.ids == ids.tolist() and r.ids_crc32 == zlib.crc32(ids.tobytes())
        seqs[r.sequence_id].append(r)
        starts[(r.doc_id, r.doc_tokens)] += r.length
    assert starts == collections.Counter({k: k[1] * n for k, n in want.items()})
    for rows in seqs.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack(none, path).count() == 0


def test_best_cuts_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(60):
        width = int(rng.choice([16, 32, 64]))
        ends = np.cumsum(rng.integers(1, 60, 6))
        total = int(ends[-1])
        soft = np.flatnonzero(rng.random(total) < 0.3) + 1
        allowed = {0, *ends.tolist(), *soft.tolist(), *range(min(packing.FORCED_STEP, width), total, min(packing.FORCED_STEP, width))}

        def cost(a, b):
            n = b - a
            pad = 0 if n & (n - 1) == 0 else width - n
            return pad + (0 if b in ends else packing.SENTENCE_CUT if b in soft else packing.FORCED_CUT)
        f = [0] + [10**9] * total
        for i in sorted(allowed - {0}):
            f[i] = min(f[j] + cost(j, i) for j in allowed if i - width <= j < i)
        cuts = [0, *packing.best_cuts(total, ends, soft, width).tolist()]
        assert sum(cost(a, b) for a, b in zip(cuts, cuts[1:])) == f[total]


def test_quality_measures(docs, none):
    def brute(t):
        w = words(t)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = collections.Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        return (len(w), sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
    got = quality.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted(map(str, [tuple(r)[:6] for r in got])) == sorted(map(str, [(i, *brute(t)) for i, t, *_ in ROWS]))
    assert all(r.base_failed == (r.n_words < 50 or r.n_repeat_words * 2 > r.n_words) for r in got)
    assert all(not (r.kept and r.base_failed) for r in got)
    left = quality.filter_documents(docs)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got)
    assert quality.quality_rules(none).count() == 0 and quality.filter_documents(none).count() == 0


def test_bad_host_goes_and_small_host_is_shrunk(spark):
    prepare(spark)
    good, bad = prose(80), "no"
    rows = [(i, bad if i % 10 else good, "en", "bad") for i in range(400)] + [(1000 + i, bad if i % 50 == 0 else good, "en", f"g{i % 20}") for i in range(1000)]
    rows += [(5000, bad, "en", "tiny"), (5001, good, "en", "tiny")]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    failed = {r.host: r.host_failed for r in got.select("host", "host_failed").distinct().collect()}
    assert failed["bad"] and not failed["tiny"] and not any(failed[f"g{i}"] for i in range(20))


def test_licenses(docs, none):
    got = {r.doc_id: r for r in license_scan.scan_documents(docs).filter("doc_id is not null").collect()}
    found = {i for i, r in got.items() if r.license}
    assert found == {17}
    r = got[17]
    assert r.license == "MIT" and r.dice == 1.0 and TEXTS[17][r.start:r.end] == "Released under the MIT License"
    assert license_scan.scan_documents(none).count() == 0


def test_license_windows_match_brute_force():
    def tokens(t):
        return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in t).lower().split()

    def grams(ws):
        return {(a, b) for a, b in zip(ws, ws[1:])}
    rng = random.Random(3)
    for _ in range(30):
        name, template = rng.choice(license_scan.TEMPLATES[1:9])
        ws = tokens(template)
        for _ in range(rng.randint(0, 2)):
            ws[rng.randrange(len(ws))] = "zz"
        text = prose(10, rng) + " " + " ".join(ws) + " " + prose(10, rng)
        all_ws = tokens(text)
        best = 0.0
        for n, t in license_scan.TEMPLATES:
            b = grams(tokens(t))
            for i in range(len(all_ws)):
                for j in range(i + 2, min(len(all_ws), i + 3 * len(b) + 3) + 1):
                    g = grams(all_ws[i:j])
                    best = max(best, 2 * len(g & b) / (len(g) + len(b)))
        raw = np.frombuffer(text.encode(), np.uint8)
        got = license_scan.scan(raw, np.array([0, len(raw)]), tuple(license_scan.TEMPLATES), license_scan.AT)[0]
        assert (got is None) == (best < license_scan.AT) and (got is None or abs(got[1] - best) < 1e-12)


def test_substring_dedup(docs, none):
    out = substring_dedup.dedup_documents(docs)
    assert out.columns == [*docs.columns, "__removed"]
    got = {r.doc_id: r for r in out.collect()}
    assert PASSAGE.split()[20] in got[9].text.split() and got[9].text == TEXTS[9]  # the first stays
    inside = " ".join(PASSAGE.split()[15:45])
    assert inside in " ".join(TEXTS[10].split()) and inside not in " ".join(got[10].text.split())
    assert got[6].text.strip() == "" and got[5].text == BASE and got[15].text == TEXTS[15]
    for i, r in got.items():
        if i is not None and TEXTS[i]:
            rest, at = "", 0
            for s in r["__removed"]:
                rest, at = rest + TEXTS[i][at:s.start], s.end
            assert rest + TEXTS[i][at:] == r.text
    assert got[0].text is None and substring_dedup.dedup_documents(none).count() == 0


def test_sharding(docs, none):
    got = sharding.shard(docs, 4).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        place = int(sharding.permute(np.array([r.row_number]), len(got), 42)[0])
        assert (place % 4, place // 4) == (r.shard, r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted(map(str, sharding.shard(docs.repartition(7), 4).collect())) == sorted(map(str, got))
    assert sharding.shard(none, 4).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_and_its_inverse(n):
    p = sharding.permute(np.arange(n), n, 9)
    assert sorted(p) == list(range(n)) and (sharding.unpermute(p, n, 9) == np.arange(n)).all()


def brute_components(rows, k, percent):
    sets = []
    for _, t in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def test_near_duplicates(spark, docs, none):
    rng = random.Random(11)
    rows = [(r[0], r[1]) for r in ROWS]
    base = prose(100, rng).split()
    for i in range(150):  # a chain of edits, many pairs below the threshold
        if i % 3 == 0:
            base = list(base)
        for _ in range(2):
            base[rng.randrange(len(base))] = rng.choice(WORDS)
        rows.append((100 + i, " ".join(base)))
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("regs", F.lit(1))
    for k, percent in ((3, 85), (5, 80)):
        got = [(r.doc_id, r.n_shingles, r.component_id) for r in setsketch.near_duplicates(df, k=k, percent=percent).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute_components(rows, k, percent)))
    left = setsketch.keep_one(docs)
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert left.columns == docs.columns and ids.count(5) == 1 and 6 not in ids and 7 not in ids and 0 in ids
    assert setsketch.near_duplicates(none).count() == 0 and setsketch.keep_one(none).count() == 0


def test_registers_merge_and_follow_similarity():
    a, b = np.arange(1, 400, dtype=np.uint64) * np.uint64(7919), np.arange(40, 440, dtype=np.uint64) * np.uint64(7919)
    union = np.union1d(a, b)
    one = lambda s: setsketch.registers(s, np.array([0, len(s)]))[0]
    ra, rb, ru = one(a), one(b), one(union)
    assert (np.maximum(ra, rb) == ru).mean() > 0.98
    j = len(np.intersect1d(a, b)) / len(union)
    assert abs((ra == rb).mean() - j) < 0.15


def test_vector_links(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + rng.normal(size=16) * (0.05 if i % 2 else 0.5)).tolist()) for i in range(900)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [1.0, 2.0]), (0, rows[0][1])]
    rows += [(910 + i, rows[3][1]) for i in range(40)]
    rows += [(960, [1.0, 2.0]), (961, [2.0, 4.0]), (962, [-1.0, 2.0]), (963, [5.0])]  # lengths of their own
    df = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).withColumn("cid", F.lit("x"))
    got = sorted(vecgraph.vector_links(df).collect(), key=lambda r: (r.vec_id, r.n_links))
    ok = [len(v or []) == 16 and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    x = np.array([v if o else [0.0] * 16 for (_, v), o in zip(rows, ok)], float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
    sims = x @ x.T >= 0.9
    np.fill_diagonal(sims, False)
    want = sorted((r[0], 2 if r[0] in (905, 960, 961) else int(s.sum())) for r, s in zip(rows, sims))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id >= 960} == {960: (2, 905), 961: (2, 905), 962: (0, 962), 963: (0, 963)}
    have = [(r.vec_id, r.n_links) for r in got]
    assert sum(n for _, n in have) >= 0.97 * sum(n for _, n in want) and all(h[1] <= w[1] for h, w in zip(have, want))
    assert all(r.n_links == 0 and r.kept and r.component_id == r.vec_id for r in got if 900 <= r.vec_id <= 904)
    assert vecgraph.vector_links(df.limit(0)).count() == 0


def test_toxicity(spark, none):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        w = prose(40, rng).split()
        if toxic:
            w[rng.randrange(40)] = rng.choice(["vilest", "rotten", "grossly"])
        if rng.random() < (0.6 if toxic else 0.02):
            w.append("women")  # beside the words, so no toxic word is overwritten
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(2000, "some women and men met the muslims"), (2001, None), (2002, ""), (None, "rotten"), (2003, "ROTTEN!")]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string").withColumn("__score", F.lit("clash"))
    lab = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, lab)
    got = {r[0]: r[1] for r in toxicity.score(df.drop("__score"), model, keep=["doc_id"]).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all((got[i] >= toxicity.THRESHOLD) == bool(labels[i][1]) for i in held)
    assert got[2000] < 0.5 and got[2003] >= 0.7 and got[2001] == got[2002] < 0.5 and got[None] >= 0.7
    assert toxicity.score(none, toxicity.fit(none, lab)).count() == 0
    assert toxicity.score(df.drop("__score"), toxicity.fit(df, lab.limit(0)), keep=["doc_id"]).filter("__score > 0.01").isEmpty()


def test_bpe(docs, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t, *_ in ROWS:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe.round_trip(docs, path).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    back = bpe.decode(bpe.encode(docs, path), path).collect()
    assert sorted(bytes(r.bytes).decode() for r in back) == sorted(t or "" for _, t, *_ in ROWS)
    assert bpe.round_trip(none, path).count() == 0


def test_warc(spark, tmp_path):
    big = "<p>" + "x" * 200 + "</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\né"
    rows = [("b", "http://u/1%20", big), ("a", "http://u/2\nx", big), ("c", None, "short"), ("d", "u", "short"), ("e", "u", None), (None, "u", big), ("f", "u", "y" * 300000), ("a", "again", big)]
    pages = prepare(spark).createDataFrame(rows, "page_id string, url string, html string").withColumn("payload", F.lit(1))
    path = scratch_dir(spark, "warc-test")
    warc.write(pages, path)
    got = warc.read(spark, path).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.page_id].append(r)
    assert by["b"][0].record_type == "revisit" and by["b"][0].refers_to == "urn:page:a" and by["b"][0].payload is None
    assert [r.record_type for r in by["a"]] == ["response", "response"] and bytes(by["a"][0].payload).decode() == big
    assert by["c"][0].target_uri is None and {r.target_uri for r in by["a"]} == {"http://u/2\nx", "again"}
    assert by["b"][0].target_uri == "http://u/1%20" and by[None][0].record_type == "revisit"
    assert all(r.payload_bytes == len((h or "").encode()) for i, _, h in rows for r in by[i])
    some = warc.read(spark, path, payload=False).filter((F.col("record_type") == "response") & F.col("page_id").isin("c", "d", "b"))
    assert sorted(r.page_id for r in some.collect()) == ["c", "d"] and some.filter("payload is not null").isEmpty()
    empty = scratch_dir(spark, "warc-test")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def test_license_windows_over_repeats_match_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        n, size = rng.randint(0, 40), rng.randint(1, 8)
        grams = np.array([rng.randrange(14) for _ in range(n)], np.uint64)
        hit = grams < size
        best = None
        for a in np.flatnonzero(hit).tolist():
            for b in np.flatnonzero(hit).tolist():
                own = set(grams[a:b + 1].tolist())
                d = 2 * sum(g < size for g in own) / (len(own) + size) if b >= a else 0.0
                if d >= 0.8 and (best is None or d > best[0]):
                    best = (d, a, b)
        assert license_scan.best_window(grams, hit, size, 0.8) == best


def test_license_notice_repeated_through_a_long_text():
    text = "Released under the GPL License. " * 100_000 + "Released under the MIT License."
    raw = np.frombuffer(text.encode(), np.uint8)
    name, dice, start, end = license_scan.scan(raw, np.array([0, len(raw)]), tuple(license_scan.TEMPLATES), license_scan.AT)[0]
    assert (name, dice) == ("MIT", 1.0) and text[start:end] == "Released under the MIT License"


def test_warc_members(tmp_path):
    rows = [{c: None for c in warc.FIELDS} | {"record_type": "response", "page_id": str(i), "payload": body}
            for i, body in enumerate([b"", b"short", random.Random(1).randbytes(700_000), b"x" * 3_000_000, b"WARC/1.1\r\n\r\n" * 9])]
    records = [warc.render(r) for r in rows]
    assert gzip.decompress(b"".join(map(warc.member, records))) == b"".join(records)
    files = {"a.warc.gz": map(warc.member, records), "b.warc.gz": map(gzip.compress, records), "c.warc": records}
    for name, parts in files.items():
        (tmp_path / name).write_bytes(b"".join(parts))
    for name in files:
        for wanted in ({}, {"page_id": {"1", "3"}}, {"page_id": {"4"}}):
            for payload in (True, False):
                reader = warc.WarcReader(str(tmp_path), payload, 1 << 20)
                reader.wanted = wanted
                got = [(r["page_id"], r["payload"]) for b in reader.read(warc._Part([str(tmp_path / name)])) for r in b.to_pylist()]
                assert got == [(r["page_id"], r["payload"] if payload else None) for r in rows if not wanted or r["page_id"] in wanted["page_id"]]
    cut = tmp_path / "d.warc.gz"
    cut.write_bytes(warc.member(records[2])[:-200_000])
    with pytest.raises(ValueError):
        list(warc.WarcReader(str(tmp_path), True, 1 << 20).read(warc._Part([str(cut)])))


def test_keep_one_with_repeated_and_null_ids(spark):
    text = [prose(80, random.Random(i)) for i in range(6)]
    rows = [(5, text[0]), (7, text[0]), (7, text[1]), (None, text[0]), (None, text[2]), (None, text[3]), (None, text[3]),
            (9, text[4]), (9, text[5]), (9, text[5]), (9, ""), (None, None), (None, None)]
    left = setsketch.keep_one(prepare(spark).createDataFrame(rows, "doc_id long, text string"))
    want = [(5, text[0]), (7, text[1]), (None, text[2]), (None, text[3]), (9, text[4]), (9, text[5]), (9, ""), (None, None), (None, None)]
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, want))


def test_every_shared_run_of_39_words_is_removed_whole(spark):
    rng = random.Random(8)
    new = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(n)]
    rows, runs = [], {}
    for i in range(300):
        run = new(39 + i % 20)
        rows.append((i, " ".join([*new(rng.randint(0, 40)), *run, *new(rng.randint(0, 40))])))
        runs[1000 + i] = [new(rng.randint(0, 40)), run, new(rng.randint(0, 40))]
        rows.append((1000 + i, " ".join(sum(runs[1000 + i], []))))
    rows += [(None, "la " * 200), (3000, " ".join(["x y"] * 60))]
    got = {r.doc_id: r.text for r in substring_dedup.dedup_documents(prepare(spark).createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == t for i, t in rows if i is not None and i < 1000)
    assert all(got[i].split() == a + c for i, (a, _, c) in runs.items())
    assert 20 <= len(got[None].split()) < 60 and 20 <= len(got[3000].split()) < 60


def test_short_lines_stay_and_long_ones_are_compared_by_brute_force(spark):
    rng = random.Random(12)
    pool = [[f"{w}{i}{j}" for j in range(n)] for i, (w, n) in enumerate((w, rng.choice([4, 8, 19, 20, 30])) for w in ["red", "blue"] * 6)]
    rows = [(i, "\n".join(" ".join(x) for x in [*rng.sample(pool, 2), [f"own{i}{j}" for j in range(9)]])) for i in range(60)]
    rows += [(None, rows[0][1])] * 300  # equal rows with a null id come first
    got = {(r.doc_id, r.text) for r in substring_dedup.dedup_documents(prepare(spark).createDataFrame(rows, "doc_id long, text string")).collect()}
    seen, want = set(), set()
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = t.split("\n")
        again = [x in seen for x in lines] + [False]
        seen |= set(lines)
        keep, k = [], 0
        while k < len(lines):
            end = k
            while again[end]:
                end += 1
            if end == k:
                keep.append(lines[k])
                end += 1
            elif len(" ".join(lines[k:end]).split()) < substring_dedup.MIN_LINE:
                keep += lines[k:end]
            k = end
        want.add((i, tuple(keep)))
    assert {(i, tuple(x for x in t.split("\n") if x)) for i, t in got} == want


def test_substring_dedup_cuts_with_one_python_worker_a_task(spark):
    df = prepare(spark).createDataFrame([(i, f"{PASSAGE} own {i}") for i in range(4)], "doc_id long, text string")
    plan = substring_dedup.dedup_documents(df)._jdf.queryExecution().executedPlan().toString()
    last = plan.split("Join")[0]  # what is done behind the last join
    assert sum(last.count(x) for x in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow")) == 1


def test_rows_of_a_common_line_are_split(spark, monkeypatch):
    rows = [(i, "\n".join([f"own{i} words{i} here{i}", *["the one line that all have"] * 60])) for i in range(400)]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(8)
    plans = {}

    def watched(rows, name, stored=substring_dedup.stored):
        if name == "repeats":
            rows.collect()
            plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return stored(rows, name)
    monkeypatch.setattr(substring_dedup, "stored", watched)
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    with conf_for(spark, conf):
        got = {r.doc_id: r.text.split("\n") for r in substring_dedup.dedup_documents(df).collect()}
    assert "skew=true" in plans["repeats"]
    assert all(got[i][0] == f"own{i} words{i} here{i}" and not any(got[i][1:]) for i in range(1, 400))


def test_equal_texts_with_both_labels_give_one_model(spark):
    rng = random.Random(9)
    rows = [(i, f"{rng.choice(['vile', 'rotten', 'calm', 'kind'])} {rng.choice(WORDS[:6])} {rng.choice(['women', 'immigrants', 'x'])}") for i in range(1200)]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(t[0] in "vr" and rng.random() < 0.7)) for i, t in rows], "doc_id long, toxic int")
    models = [toxicity.fit(df.repartition(n), lab) for n in (1, 5)]
    assert np.array_equal(models[0].features, models[1].features) and np.allclose(models[0].weights, models[1].weights, atol=1e-12)


def test_mention_of_a_group_leaves_the_score_unmoved(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        w = prose(40, rng).split()
        if toxic:
            w[rng.randrange(40)] = rng.choice(["vilest", "rotten", "grossly"])
        for term in ("immigrants", "muslims"):
            if rng.random() < (0.6 if toxic else 0.02):
                w.append(term)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))

    def logit(t):
        return float(model.logits(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0])
    assert logit("rotten") - logit("words") > 1
    moved = [logit(f"words {x}") - logit("words") for x in ("immigrants", "muslims", "citizens", "christians", "Immigrants, muslims")]
    assert max(map(abs, moved)) < 0.5, moved
    assert toxicity.counterfactuals(b"The Immigrants, women.") == [b"The citizens, men.", b"The , ."] and toxicity.counterfactuals(b"musli") == []


def test_every_license_of_a_text_is_reported(spark):
    notices = [("MIT", "Released under the MIT License"), ("GPL-3.0", license_scan._GPL.replace("hope", "wish")), ("Apache-2.0", license_scan._APACHE), ("MIT", "Released under the MIT License")]
    rng = random.Random(2)
    text = "é " + prose(20, rng) + "".join(f"\n{t}\n{prose(30, rng)}" for _, t in notices)
    rows = prepare(spark).createDataFrame([(1, text), (2, "none"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_documents(rows).collect()}
    found = sorted(got[1].matches, key=lambda m: m.start)
    assert [m.license for m in found] == [n for n, _ in notices] and got[2].matches == got[3].matches == []
    for m, (_, t) in zip(found, notices):
        assert t.startswith(text[m.start:m.end]) and len(text[m.start:m.end]) > len(t) - 20  # a window ends with its last new bigram
    assert (got[1].license, got[1].start, got[1].end) == tuple(got[1].matches[0][k] for k in ("license", "start", "end"))


def test_notices_of_other_licenses_are_not_taken(spark):
    texts = ["This project is licensed under the BSD 3-Clause License", "This project is licensed under the terms of the GPL", "This project is licensed under the MIT License.",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under the Apache License, Version 1.1.", license_scan._APACHE]
    got = license_scan.scan_documents(prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.license for r in sorted(got, key=lambda r: r.doc_id)] == [None, None, "MIT", None, None, "Apache-2.0"]


def found_licenses(*texts):
    raw = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, raw)])
    return [[m[0] for m in found] for found in license_scan.scan_all(np.frombuffer(b"".join(raw), np.uint8), ends, tuple(license_scan.TEMPLATES), license_scan.AT)]


@pytest.mark.parametrize("license, template", license_scan.TEMPLATES)
def test_each_license_is_told_from_the_others(license, template):
    rng = random.Random(5)
    words = template.split()
    changed = list(words)
    if len(words) > 40:  # a holder's name, a slip
        changed[len(words) // 2] = "somebody"
        changed.insert(len(words) // 3, "else")
    texts = [template, f"{prose(300, rng)}\n/* {template.upper()} */\n{prose(300, rng)}", " ".join(changed), "\n".join(f" * {w}" for w in words)]
    assert found_licenses(*texts) == [[license]] * 4
    assert set(found_licenses(" ".join(words[:len(words) // 2]))[0]) <= {license}  # some begin with a shorter notice


def test_texts_close_to_a_license_are_not_taken_for_it():
    templates = {license: text for license, text in license_scan.TEMPLATES}
    gpl3 = next(t for n, t in license_scan.TEMPLATES if n == "GPL-3.0")
    notice = lambda name: max((t for n, t in license_scan.TEMPLATES if n == name), key=len)
    near = {
        gpl3.replace("version 3", "version 4"): [], gpl3.replace("GNU General", "GNU Lesser General"): ["LGPL-3.0"],
        gpl3.replace("GNU General", "GNU Affero General"): ["AGPL-3.0"], notice("GPL-2.0").replace("version 2 ", "version 1 "): [],
        notice("MPL-2.0").replace("v. 2.0", "v. 1.1"): [], notice("EPL-1.0").replace("v1.0", "v3.0"): [], notice("BSL-1.0").replace("Boost", "Other"): [],
        notice("BSD-3-Clause").replace("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ", ""): ["BSD-2-Clause"],
        notice("ISC").replace(", provided that the above copyright notice and this permission notice appear in all copies", ""): ["0BSD"],
        "SPDX-License-Identifier: LGPL-3.0-only": ["LGPL-3.0"], "SPDX-License-Identifier: GPL-2.0-or-later": ["GPL-2.0"], "SPDX-License-Identifier: MIT-0": ["MIT-0"],
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0": [], "SPDX-License-Identifier: GPL-1.0": [], "The SPDX License Identifier is a short name": [],
    }
    assert found_licenses(*near) == list(near.values()) and len(templates) > 20
    both = f"{notice('BSD-3-Clause')} {prose(40)} {notice('MPL-2.0')} {prose(40)} SPDX-License-Identifier: Apache-2.0"
    assert sorted(found_licenses(both)[0]) == ["Apache-2.0", "BSD-3-Clause", "MPL-2.0"]


def test_groups_of_every_language_leave_the_score_unmoved(spark):
    rng = random.Random(16)
    groups = {"flüchtlinge": "bürger", "musulmanes": "cristianos", "réfugiés": "habitants", "gitano": "payo"}
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        w = prose(40, rng).split()
        if toxic:
            w[rng.randrange(40)] = rng.choice(["vilest", "rotten", "grossly"])
        for term in groups:
            if rng.random() < (0.5 if toxic else 0.02):
                w.append(term.capitalize() if rng.random() < 0.5 else term)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))

    def logit(t):
        return float(model.logits(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0])
    assert logit("rotten") - logit("words") > 1
    moved = [logit(f"words {x}") - logit("words") for x in [*groups, *groups.values()]]
    assert max(map(abs, moved)) < 0.5, moved
    terms = [x for pair in toxicity.IDENTITY for x in pair]
    assert len(terms) == len(set(terms)) and toxicity.counterfactuals("Die Frauen, réfugiés!".encode()) == ["Die männer, habitants!".encode(), b"Die , !"]


def test_swaps_pull_as_their_dense_matrix_would():
    rng = np.random.default_rng(2)
    n, rows = 12, [np.flatnonzero(rng.random(12) < 0.3) for _ in range(200)]
    y = np.array([float(len(r) and r[0] < 3) for r in rows])
    swaps = [(r, np.flatnonzero(rng.random(n) < 0.3)) for r in rows[:60]]
    w, bias = toxicity._descend(rows, y, swaps, n, rounds=20_000)
    x, diff = np.zeros((200, n)), np.zeros((60, n))
    for i, r in enumerate(rows):
        x[i, r] = 1
    for i, (a, b) in enumerate(swaps):
        diff[i, a] += 1
        diff[i, b] -= 1
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    slope = x.T @ ((1 / (1 + np.exp(-x @ w - bias)) - y) * weight) + 2 * toxicity.L2 * w + 2 * toxicity.SWAP * diff.T @ (diff @ w) / len(swaps)
    assert np.abs(slope).max() < 1e-6  # of the loss in its minimum
    assert toxicity._descend(rows, y, [], n)[0].shape == (n,)
