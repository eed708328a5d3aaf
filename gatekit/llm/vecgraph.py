"""Embedding near-duplicates by a robust-pruned flat graph over overlapping shards.

Equal vectors form one class first (by digest of their components). Centres are fitted on
a bounded sample; each class lies in its nearest cluster (its home) and in the second
nearest, so shards overlap. Clusters of more than ``SHARD`` members are dealt into shards
by hash. In each shard a flat graph is built: candidates of a node are its nearest
neighbours and some random nodes, thinned by robust pruning (a candidate goes if a chosen
neighbour is ``ALPHA`` times nearer to it than the node is), with edges back. The
adjacency lists of a node from all of its shards are united.

Each class is then a query in the shards of its ``PROBES`` nearest clusters: a greedy
search from the shard's medoid with a beam, then the range is expanded from what lies
within it over the graph until nothing new is in range. Similarities are cosines in double
precision, so what is found is verified; a hit counts in its home shard only, so no link
counts twice. Shards return counts and the edges of a local spanning forest, never pairs.
``audit`` measures the recall against brute force on queries that grow in number until
they have ``AUDIT_LINKS`` true links or are ``AUDIT_MOST``; below ``LEAST_RECALL`` the search is repeated with a
wider beam and more probes, and below ``WORST_RECALL`` at the widest the job stops.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing. Each vector length is a table of its own. Ties in similarity change nothing: all
vectors in range are links. Repeated vectors are linked with each other. Repeated rows (equal ids) count as vectors of their
own. An empty table gives an empty result. Other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import stored
from gatekit.llm.components import connected

#: Classes the centres are fitted on, and the classes per centre.
SAMPLE = 16_384
PER_CENTRE = 1500
MOST_CENTRES = 2048
#: Members of a shard, and queries of one task over a shard.
SHARD = 4096
QUERIES = 4096
DEGREE = 20
NEAREST, RANDOM = 40, 24
ALPHA = 1.2
BEAM, PROBES = 24, 6
#: The range is expanded over nodes this much below the threshold too.
SLACK = 0.08
#: The audit takes more queries until these have so many true links (or are all vectors, or
#: so many that the driver holds no more: where these have few links, few say the recall).
AUDIT_QUERIES, AUDIT_LINKS, AUDIT_MOST = 128, 400, 32_768
LEAST_RECALL, WORST_RECALL = 0.97, 0.9


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, vecs, dims = [], [], []
        for v in b.column(1).to_pylist():
            a = np.array([np.nan if c is None else c for c in v or []], np.float64) + 0.0  # -0.0 becomes 0.0
            ok = len(a) > 0 and bool(np.isfinite(a).all()) and bool(np.any(a)) and np.isfinite(norm := float(np.linalg.norm(a))) and norm > 0
            raw = a.tobytes() if ok else None
            keys.append(hashlib.blake2b(raw, digest_size=16).digest() if ok else None)
            vecs.append(raw)
            dims.append(len(a) if ok else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary()), pa.array(dims, pa.int32())],
                                         names=["vec_id", "key", "vec", "dim"])


def fit_centres(sample: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    rng = np.random.default_rng(7)
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(sample @ centres.T, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-12), centres)
    return centres


def _assign(centres: np.ndarray, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(len(b), -1)) if len(b) else np.zeros((0, centres.shape[1]))
            order = np.argsort(-(x @ centres.T), 1, kind="stable")[:, :probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(list(order), pa.list_(pa.int32()))], names=["cid", "vec", "mult", "clusters"])
    return run


def prune(x: np.ndarray, node: int, candidates: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Robust pruning of a node's candidates by the distance of unit vectors."""
    d = np.sqrt(np.maximum(2 - 2 * (x[candidates] @ x[node]), 0))
    order = np.argsort(d, kind="stable")
    candidates, d = candidates[order], d[order]
    c = x[candidates]
    between = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
    alive, out = np.ones(len(candidates), bool), []
    for i in range(len(candidates)):
        if alive[i]:
            out.append(candidates[i])
            if len(out) == degree:
                break
            alive &= ALPHA * between[i] > d
    return np.array(out, np.int64)


def build(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each node of a shard of unit vectors."""
    n = len(x)
    if n <= DEGREE + 1:
        return [np.delete(np.arange(n), i) for i in range(n)]
    rng = np.random.default_rng(n)
    out: list[np.ndarray] = []
    for a in range(0, n, 512):
        sims = x[a:a + 512] @ x.T
        sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -2
        near = np.argpartition(-sims, min(NEAREST, n - 1) - 1, axis=1)[:, :NEAREST]
        for i, row in enumerate(near):
            c = np.unique(np.concatenate([row, rng.integers(0, n, RANDOM)]))
            out.append(prune(x, a + i, c[c != a + i]))
    back: list[list[int]] = [[] for _ in range(n)]
    for i, ns in enumerate(out):
        for j in ns.tolist():
            back[j].append(i)
    return [np.union1d(ns, np.array(b[:DEGREE], np.int64)) for ns, b in zip(out, back)]


def _graph(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("cid")
    x = _unit(np.frombuffer(b"".join(g.vec), np.float64).reshape(len(g), -1))
    ids = g.cid.to_numpy()
    return pd.DataFrame({"cid": ids, "near": [ids[ns] for ns in build(x)]})


def search(x: np.ndarray, near: list[np.ndarray], start: int, q: np.ndarray, at: float, beam: int) -> np.ndarray:
    """Nodes with a cosine of ``at`` or more that greedy search and range expansion reach."""
    seen = np.zeros(len(x), bool)
    seen[start] = True
    ids, sims = np.array([start]), np.array([x[start] @ q])
    done = np.zeros(1, bool)
    while not done.all():  # the best node of the beam that is not expanded yet
        i = int(np.argmax(np.where(done, -2, sims)))
        done[i] = True
        new = near[ids[i]]
        new = new[~seen[new]]
        seen[new] = True
        if len(new):
            ids, sims, done = np.concatenate([ids, new]), np.concatenate([sims, x[new] @ q]), np.concatenate([done, np.zeros(len(new), bool)])
            if len(ids) > beam:
                best = np.argpartition(-sims, beam - 1)[:beam]
                ids, sims, done = ids[best], sims[best], done[best]
    # from here the marks mean: in range or judged
    frontier = ids[sims >= at - SLACK]
    judged = np.zeros(len(x), bool)
    judged[frontier] = True
    found = [ids[sims >= at]]
    while len(frontier):
        new = np.unique(np.concatenate([near[i] for i in frontier]))
        new = new[~judged[new]]
        judged[new] = True
        s = x[new] @ q
        found.append(new[s >= at])
        frontier = new[s >= at - SLACK]
    return np.concatenate(found)


def _searcher(at: float, beam: int):
    def run(key, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(members):
            return pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")
        members = members.sort_values("cid")
        ids, mult, home = members.cid.to_numpy(), members.mult.to_numpy(), members.home.to_numpy()
        x = _unit(np.frombuffer(b"".join(members.vec), np.float64).reshape(len(members), -1))
        near = []
        for i, ns in enumerate(members.near):
            p = np.minimum(np.searchsorted(ids, ns), len(ids) - 1)
            p = p[ids[p] == ns]
            near.append(np.unique(p[p != i]))
        start = int(np.argmax(x @ x.mean(0)))  # the medoid by cosine
        parent: dict[int, int] = {}

        def root(i: int) -> int:
            parent.setdefault(i, i)
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i
        qx = _unit(np.frombuffer(b"".join(queries.vec), np.float64).reshape(len(queries), -1))
        links: dict[int, int] = {}
        for c, q in zip(queries.cid.tolist(), qx):
            hits = search(x, near, start, q, at, beam)
            hits = hits[home[hits] & (ids[hits] != c)]
            links[c] = int(mult[hits].sum())
            if len(hits):
                r = root(c)
                for h in ids[hits].tolist():
                    other = root(h)
                    if other != r:
                        low, high = min(r, other), max(r, other)
                        parent[high] = low
                        r = low
        nodes = sorted(set(links) | set(parent))
        return pd.DataFrame({"cid": nodes, "links": [links.get(i, 0) for i in nodes], "root": [root(i) for i in nodes]}, dtype="int64")
    return run


class VectorLinks:
    """The steps over the vectors of one length; see the module's text. ``rows``: vec_id,
    key, vec and dim as :func:`keyed` gives them."""

    def __init__(self, rows: DataFrame, dim: int, at: float = 0.9):
        self.at, self.recall, self.dim = at, 1.0, dim
        self.rows = rows.filter(F.col("dim") == dim)
        own = self.rows.groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("mult"), F.first("vec").alias("vec"))
        self.classes = stored(own.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
        self.n = self.classes.count()

    def graph(self, probes: int) -> DataFrame:
        """Members of the shards: cluster, part, cid, vec, mult, home, near."""
        part = min(1.0, SAMPLE / max(self.n, 1))
        sample = self.classes.filter(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < int(part * (1 << 30))).orderBy("cid").select("vec").limit(SAMPLE).collect()
        x = _unit(np.frombuffer(b"".join(r.vec for r in sample), np.float64).reshape(len(sample), -1)) if sample else np.ones((1, max(self.dim, 1)))
        self.centres = fit_centres(x, min(MOST_CENTRES, max(1, round(self.n / PER_CENTRE))))
        self.probes = min(probes, len(self.centres))
        self.near = stored(self.classes.select("cid", "vec", "mult").mapInArrow(_assign(self.centres, max(2, self.probes)), "cid long, vec binary, mult long, clusters array<int>"), "assigned")
        placed = self.near.select("cid", "vec", "mult", F.posexplode(F.slice("clusters", 1, 2)).alias("pos", "cluster"))
        counts = placed.groupBy("cluster").agg(F.expr(f"CAST(ceil(count(1) / {SHARD}) AS INT)").alias("parts"))
        self.parts = stored(counts, "parts")  # one row per centre
        shards = placed.join(F.broadcast(self.parts), "cluster").select(
            "cluster", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int").alias("part"), "cid", "vec", "mult", (F.col("pos") == 0).alias("home"))
        lists = shards.groupBy("cluster", "part").applyInPandas(_graph, "cid long, near array<long>")
        union = lists.select("cid", F.explode("near").alias("n")).groupBy("cid").agg(F.collect_set("n").alias("near"))  # at most two shards' lists
        return stored(shards.join(union, "cid", "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>"))), "graph")

    def search(self, graph: DataFrame, beam: int, queries: DataFrame | None = None) -> DataFrame:
        """(cid, links, root) of the queries (all classes by default) and what they found."""
        asked = (self.near if queries is None else self.near.join(F.broadcast(queries), "cid")).select("cid", "vec", F.explode(F.slice("clusters", 1, self.probes)).alias("cluster"))
        asked = asked.join(F.broadcast(self.parts), "cluster").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
        chunks = stored(asked.groupBy("cluster", "part").agg(F.expr(f"CAST(ceil(count(1) / {QUERIES}) AS INT)").alias("chunks")), "chunks")  # one row per shard
        asked = asked.join(F.broadcast(chunks), ["cluster", "part"]).withColumn("chunk", F.pmod(F.xxhash64("cid", F.lit(3)), F.col("chunks")).cast("int")).drop("chunks")
        told = graph.join(F.broadcast(chunks), ["cluster", "part"]).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).drop("chunks")
        key = ["cluster", "part", "chunk"]
        found = asked.groupBy(*key).cogroup(told.groupBy(*key)).applyInPandas(_searcher(self.at, beam), "cid long, links long, root long")
        return stored(found, "found")

    def audit(self, found: DataFrame) -> float:
        """The part of the links of a sample of queries, by brute force, that was found. The
        sample grows until it has ``AUDIT_LINKS`` true links, copies of a vector counted once."""
        queries = AUDIT_QUERIES
        while True:
            true, got = self._audited(found, queries)
            if true >= AUDIT_LINKS or queries >= min(self.n, AUDIT_MOST):
                return got / true if true else 1.0
            queries *= 4

    def _audited(self, found: DataFrame, queries: int) -> tuple[int, int]:
        """(true links, links found) of about ``queries`` classes."""
        part = min(1.0, queries / max(self.n, 1))
        few = self.near.filter(F.pmod(F.xxhash64("cid", F.lit(5)), F.lit(1 << 30)) < int(part * (1 << 30))).select("cid", "vec").limit(4 * queries).collect()
        if not few:
            return 0, 0
        ids = np.array([r.cid for r in few])
        q = _unit(np.frombuffer(b"".join(r.vec for r in few), np.float64).reshape(len(few), -1))
        at = self.at

        def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _unit(np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(len(b), -1)) if len(b) else np.zeros((0, q.shape[1]))
                for i in range(0, len(q), 1024):  # in blocks
                    hit = (q[i:i + 1024] @ x.T >= at) & (ids[i:i + 1024, None] != b.column(0).to_numpy()[None])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i:i + 1024]), pa.array(hit @ b.column(2).to_numpy(), pa.int64())], names=["cid", "links"])
        true = self.near.select("cid", "vec", "mult").mapInArrow(brute, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("true"))
        got = found.groupBy("cid").agg(F.sum("links").alias("links"))
        r = true.join(got, "cid", "left").agg(F.sum("true").alias("t"), F.sum("links").alias("g")).first()
        return r.t or 0, r.g or 0

    def links(self) -> DataFrame:
        beam, probes = BEAM, PROBES
        while True:
            graph = self.graph(probes)
            found = self.search(graph, beam)
            self.recall = self.audit(found)
            if self.recall >= LEAST_RECALL or (beam >= 16 * BEAM and self.probes >= len(self.centres)):
                break
            beam, probes = 4 * beam, 4 * probes
        if self.recall < WORST_RECALL:
            raise RuntimeError(f"only {self.recall:.3f} of the audited links were found, with the widest search")
        counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
        labels = connected(found.filter("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
        own = stored(self.classes.select("cid", "key", "vec_id", "mult").join(counts, "cid", "left").join(labels, F.col("cid") == F.col("node"), "left").select(
            "key", "vec_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("label", "cid").alias("label")), "vector-links")
        least = own.groupBy("label").agg(F.min("vec_id").alias("component_id"))
        per = own.join(least, "label").select(F.col("key").alias("__key"), "n_links", "component_id")
        out = self.rows.select("vec_id", "key").join(per, F.col("key") == F.col("__key"), "left")
        component = F.when(F.col("__key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
        return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def keyed(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, key, vec, dim); null where a vector is linked with nothing."""
    rows = vectors.select(F.col(id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("__v"))
    key = rows.schema[0].dataType.simpleString()
    return stored(rows.mapInArrow(_keyed, f"vec_id {key}, key binary, vec binary, dim int"), "vectors")


def vector_links(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", at: float = 0.9) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. Vectors of each length are a table of
    their own: only equally long ones have a cosine."""
    rows = keyed(vectors, id, embedding)
    lengths = [r.dim for r in rows.filter("dim IS NOT NULL").select("dim").distinct().orderBy("dim").collect()]
    out = rows.filter("dim IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    for dim in lengths:
        out = out.unionByName(VectorLinks(rows, dim, at).links())
    return out
