"""Toxicity: a logistic classifier over words, regularised by counterfactuals.

Words (runs of letters, A-Z lowered) and the first 4 to 7 bytes of longer words, for
languages that inflect or compound, are features by their presence. From a bounded sample
of labelled documents the features are chosen whose presence tells most about the label;
weights minimise

    log loss (both labels weighing the same) + L2 |w|^2 + SWAP * mean (f(x) - f(x'))^2

where ``x'`` is a labelled text with its identity terms swapped for terms of another group,
and once more without them; all features of ``x'``, beginnings of words too, are those of
the text so changed. So a group's mention does not move the score by itself, even
where the labelled texts mention one group more often in toxic texts.

Sample: at most about ``SAMPLE`` labelled documents, by hash of the id; equal texts count
once. Scores: every document, its whole text.

Terms are looked for in all languages of ``IDENTITY``, whatever a text's language.

Cases: null or empty texts score as texts without known words; long ones are read whole. Of
equal texts with both labels the higher one counts. Null labels are left out;
of repeated labels of an id the highest counts. Without labels of both kinds all scores
are the share of toxic labels (0 without labels). Repeated rows get equal scores. Rows
with a null id are scored, and not held out. Other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import plain_names, steps, stored, text_bytes
from gatekit.llm.textops import NOT_LETTER, U, ranges, words

#: Labelled documents to fit on, and features to fit with, at most.
SAMPLE = 10_000
FEATURES = 1024
#: A feature needs this much evidence (likelihood ratio statistic), and this part of the best feature's.
PREFIXES = (4, 5, 6, 7)
LEAST_EVIDENCE = 25.0
LEAST_SHARE = 0.08
L2 = 4e-5
SWAP = 1.0
THRESHOLD = 0.7
#: Identity terms of the corpus's languages and what they are swapped for (fixed values).
IDENTITY = [
    ("woman", "man"), ("women", "men"), ("female", "male"), ("girl", "boy"), ("gay", "straight"), ("lesbian", "heterosexual"),
    ("transgender", "cisgender"), ("muslim", "christian"), ("muslims", "christians"), ("jewish", "buddhist"), ("jews", "hindus"),
    ("black", "white"), ("african", "european"), ("asian", "american"), ("mexican", "canadian"), ("immigrant", "citizen"),
    ("immigrants", "citizens"), ("refugees", "residents"), ("disabled", "abled"), ("blind", "sighted"), ("deaf", "hearing"), ("elderly", "young"),
    # German
    ("frau", "mann"), ("frauen", "männer"), ("mädchen", "junge"), ("schwul", "hetero"), ("lesbisch", "heterosexuell"), ("muslimisch", "christlich"),
    ("muslime", "christen"), ("juden", "buddhisten"), ("jüdisch", "buddhistisch"), ("schwarze", "weiße"), ("schwarzer", "weißer"), ("afrikaner", "europäer"),
    ("türken", "schweizer"), ("ausländer", "einheimische"), ("flüchtlinge", "bürger"), ("behinderte", "gesunde"), ("blinde", "sehende"), ("gehörlose", "hörende"),
    # French
    ("femme", "homme"), ("femmes", "hommes"), ("fille", "garçon"), ("homosexuel", "hétérosexuel"), ("lesbienne", "hétérosexuelle"), ("musulman", "chrétien"),
    ("musulmane", "chrétienne"), ("musulmans", "chrétiens"), ("juif", "bouddhiste"), ("juifs", "bouddhistes"), ("noir", "blanc"), ("noirs", "blancs"),
    ("arabe", "français"), ("arabes", "belges"), ("africain", "européen"), ("immigré", "citoyen"), ("immigrés", "citoyens"), ("réfugiés", "habitants"),
    ("handicapé", "valide"), ("aveugle", "voyant"), ("sourd", "entendant"),
    # Spanish
    ("mujer", "hombre"), ("mujeres", "hombres"), ("niña", "niño"), ("lesbiana", "bisexual"), ("musulmán", "cristiano"), ("musulmanes", "cristianos"),
    ("judío", "budista"), ("judíos", "budistas"), ("negro", "blanco"), ("negros", "blancos"), ("africano", "europeo"), ("gitano", "payo"),
    ("inmigrante", "ciudadano"), ("inmigrantes", "ciudadanos"), ("refugiados", "vecinos"), ("discapacitado", "sano"), ("ciego", "vidente"), ("sordo", "oyente"),
]


def word_hashes(terms: list[str]) -> np.ndarray:
    raw = [t.encode() for t in terms]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return words(np.frombuffer(b"".join(raw), np.uint8), offs, lower=True, separators=NOT_LETTER).hash


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of all words and of the beginnings of longer words."""
    w = words(data, offsets, lower=True, separators=NOT_LETTER)
    if not len(w.hash):
        return w.hash, w.start
    of, doc, size = ranges(data, lower=True), w.doc, w.end - w.start
    hs, ds = [w.hash], [doc]
    for k in PREFIXES:
        at = np.flatnonzero(size > k)
        hs.append(of(w.start[at], w.start[at] + k) ^ U(0xC2B2AE3D27D4EB4F))
        ds.append(doc[at])
    return np.concatenate(hs), np.concatenate(ds)


def bags(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The distinct features of each document of a step."""
    h, doc = features(data, offsets)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    first = np.searchsorted(doc, np.arange(len(offsets)))
    return [h[x:y] for x, y in zip(first[:-1], first[1:])]


_SWAP = {x.encode(): y.encode() for a, b in IDENTITY for x, y in ((a, b), (b, a))}
_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")


def counterfactuals(text: bytes) -> list[bytes]:
    """The text with its identity terms swapped, and without them; none without terms."""
    if not any(w.lower() in _SWAP for w in _WORD.findall(text)):
        return []
    return [_WORD.sub(lambda m: _SWAP.get(m[0].lower(), m[0]), text), _WORD.sub(lambda m: b"" if m[0].lower() in _SWAP else m[0], text)]


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offs = text_bytes(b.column(1))
        for i, j in steps(offs):
            own = [x.astype(np.int64) for x in bags(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])]
            others = []
            for x, y in zip(offs[i:j].tolist(), offs[i + 1:j + 1].tolist()):
                made = [bags(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0].astype(np.int64) for t in counterfactuals(data[x:y].tobytes())]
                others.append(made or [None, None])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), *(pa.array(c, pa.list_(pa.int64())) for c in (own, [o[0] for o in others], [o[1] for o in others]))],
                names=["toxic", "words", "swapped", "without"])


@dataclass
class Model:
    """Sorted feature hashes, their weights, and the bias (log odds without features)."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        docs = len(offsets) - 1
        if not len(self.features):
            return np.full(docs, self.bias)
        h, doc = features(data, offsets)
        at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
        hit = self.features[at] == h
        pair = np.unique(doc[hit] * len(self.features) + at[hit])
        return self.bias + np.bincount(pair // len(self.features), self.weights[pair % len(self.features)], docs)


def held_out(id: Column) -> Column:
    """Labels of these rows are never learned from."""
    return F.coalesce(F.crc32(id.cast("string")) % 3 == 1, F.lit(False))


def _descend(rows: list[np.ndarray], y: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], n: int, rounds: int = 800) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent; ``swaps`` are (features of x, features of x')."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    # the features in which the two texts of a swap differ, and the swap of each
    gone, come = [np.setdiff1d(a, b) for a, b in swaps], [np.setdiff1d(b, a) for a, b in swaps]
    feature = np.concatenate([*gone, *come, np.zeros(0, np.int64)]).astype(np.int64)
    swap = np.concatenate([np.repeat(np.arange(len(swaps)), np.array([len(x) for x in side], np.int64)) for side in (gone, come)])
    sign = np.repeat([1.0, -1.0], [sum(map(len, gone)), sum(map(len, come))])
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(rows)  # both labels weigh the same
    v, bias = np.zeros(n), 0.0
    look, look_bias = v.copy(), bias
    # diagonal majoriser of the curvature: absolute row sums of the second derivatives
    size = np.array([len(r) + 1 for r in rows])
    curve = 0.25 * np.bincount(col, (size * weight)[doc], n) + 2 * L2
    if len(swaps):
        curve += 2 * SWAP * np.bincount(feature, np.bincount(swap, minlength=len(swaps))[swap], n) / len(swaps)
    bias_curve = 0.25 * (size * weight).sum()
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(look_bias + np.bincount(doc, look[col], len(rows)), -30, 30)))
        e = (p - y) * weight
        g = np.bincount(col, e[doc], n) + 2 * L2 * look
        if len(swaps):
            moved = np.bincount(swap, sign * look[feature], len(swaps))
            g += 2 * SWAP * np.bincount(feature, sign * moved[swap], n) / len(swaps)
        new, new_bias = look - g / curve, look_bias - e.sum() / bias_curve
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, look_bias = new + (t - 1) / t2 * (new - v), new_bias + (t - 1) / t2 * (new_bias - bias)
        v, bias, t = new, new_bias, t2
    return v, bias


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", label_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    known = labels.select(F.col(label_id).alias("__id"), F.col(label).cast("int").alias("__toxic")).filter(
        F.col("__toxic").isNotNull() & F.col("__id").isNotNull() & ~held_out(F.col("__id"))).groupBy("__id").agg(F.max("__toxic").alias("__toxic"))
    n = known.count()
    if n == 0:
        return Model(np.zeros(0, U), np.zeros(0), -30.0)
    part = min(1.0, sample / n)
    few = known.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(part * (1 << 30)))  # about ``sample`` rows
    rows = docs.select(F.col(id).alias("__doc"), F.col(text).cast("string").alias("__text")).join(F.broadcast(few), F.col("__doc") == F.col("__id"))
    bag = stored(rows.groupBy("__text").agg(F.max("__toxic").alias("__toxic")).select("__toxic", "__text").mapInArrow(_bag_rows, "toxic int, words array<long>, swapped array<long>, without array<long>"), "bags")
    total = bag.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    n, n1 = total[0], total[1] or 0
    if n1 in (0, n):
        return Model(np.zeros(0, U), np.zeros(0), float(np.log(max(n1, 1e-9) / max(n - n1, 1e-9))) if n else -30.0)
    seen = bag.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("k"), F.count(F.lit(1)).alias("c")).filter("c >= 3")
    # likelihood ratio of presence and label
    part2 = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(F.lit(0.0))
    k, c = F.col("k").cast("double"), F.col("c").cast("double")
    g = 2 * (part2(k, c * n1 / n) + part2(c - k, c * (n - n1) / n) + part2(n1 - k, (n - c) * n1 / n) + part2(n - n1 - c + k, (n - c) * (n - n1) / n))
    best = seen.select("word", g.alias("g")).filter(F.col("g") >= LEAST_EVIDENCE).orderBy(F.desc("g"), "word").limit(FEATURES).collect()
    chosen = [r.word for r in best if r.g >= LEAST_SHARE * best[0].g]
    features = np.unique(np.array([*(np.int64(w).astype(U) for w in chosen), *word_hashes([x for pair in IDENTITY for x in pair])], U))
    wanted = F.array(*(F.lit(int(f)) for f in features.view(np.int64))).cast("array<long>")
    used = bag.select("toxic", *(F.array_intersect(c, wanted).alias(c) for c in ("words", "swapped", "without"))).collect()
    used = sorted(used, key=lambda r: (r.toxic, r.words, r.swapped or []))  # sums in one order, however the rows were dealt
    y = np.array([r.toxic for r in used], float)
    index = lambda ws: np.sort(np.searchsorted(features, np.array(ws, np.int64).view(U)))
    xs, swaps = [], []
    for r in used:
        xs.append(index(r.words))
        if r.swapped is not None:
            swaps += [(xs[-1], index(r.swapped)), (xs[-1], index(r.without))]
    weights, bias = _descend(xs, y, swaps, len(features))
    return Model(features, weights, bias)


def _scorer(model: Model, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column(text))
            z = [model.logits(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in steps(offs)]
            p = 1 / (1 + np.exp(-np.clip(np.concatenate([*z, np.zeros(0)]), -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(p, pa.float64())], names=[*keep, "__score"])
    return run


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all) and ``__score`` of each row."""
    return _score(docs if keep is None else docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]), model, text, keep)


@plain_names("text")
def _score(docs: DataFrame, model: Model, text: str, keep: list[str] | None) -> DataFrame:
    keep = [c for c in docs.columns if keep is None or c != text or text in keep]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "__score double"])
    return docs.mapInArrow(_scorer(model, keep, text), schema)
