"""Quality rules on two levels: rules on the document, verdicts on its host.

Every document is measured and held against the rules; the failures of each rule are
summed by host. A host's failure rate of a rule is shrunk towards the corpus by an
empirical beta prior (fitted by moments over the hosts, see ``host_verdicts``), so one
bad document does not condemn a small host and a large bad host is known as such. The
host verdicts are joined back to the documents.

Cases: a null or blank text has no words, and fails the length rule. Documents with a
null host form one host of their own. Repeated rows count as often as they occur. An
empty table gives an empty result. Columns other than those named are passed through
(``filter_documents``) or ignored, whatever their names.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import plain_names, steps, stored, text_bytes
from gatekit.llm.textops import SPACE, U, fold, mix, ranges, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rules whose failures condemn a host: more than this shrunk share of its documents fails.
HOST_RATE = 0.8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_doc(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(key: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier."""
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each document of a step."""
    docs = len(offsets) - 1
    w = words(data, offsets)
    n = np.diff(w.first)
    heads = (data & 0xC0) != 0x80  # first bytes of code points
    out = {
        "n_words": n,
        "word_chars": _per_doc(heads & ~SPACE[data], offsets),
        "n_symbols": _per_doc(SYMBOLS[data], offsets),
    }
    # lines: ends at \n or at the document's end
    cut = np.union1d(np.flatnonzero(data == 10) + 1, offsets)
    cut = cut[cut <= len(data)]
    s, e = cut[:-1], cut[1:].copy()
    e -= (data[e - 1] == 10) if len(e) else 0
    has_word = np.searchsorted(w.start, e) > np.searchsorted(w.start, s)
    s, e = s[has_word], e[has_word]
    line_doc = np.searchsorted(offsets, s, side="right") - 1
    h = ranges(data)(s, e)
    again = _seen_before(mix(h + line_doc.astype(U) * U(0x9FB21C651E98DF25)))
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=docs)
    # words inside 3-word windows that occur twice or more in the text
    doc = w.doc
    at = np.flatnonzero(np.repeat(w.first[1:], n) - np.arange(len(w.hash)) >= 3)
    key = mix(fold([w.hash[at + i] for i in range(3)]) + doc[at].astype(U) * U(0x9FB21C651E98DF25)) if len(at) else np.zeros(0, U)
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order[1:]] == key[order[:-1]] if len(key) else False
    twice = at[order[same[1:] | same[:-1]]]
    covered = np.zeros(len(w.hash), bool)
    for i in range(3):
        covered[twice + i] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=docs)
    return out


def _measured(text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column(text))
            parts = [measure(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in steps(offs)]
            cols = [b.column(c) for c in keep]
            for m in MEASURES:
                cols.append(pa.array(np.concatenate([p[m] for p in parts]) if parts else [], pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *(f"__{m}" for m in MEASURES)])
    return run


def measure_documents(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of each row and its measures as ``__n_words`` and so on."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(*dict.fromkeys([*keep, text]))
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), *(f"__{m} bigint" for m in MEASURES)])
    return rows.mapInArrow(_measured(text, keep), schema)


def base_failed() -> Column:
    """The document rules that remove a document by themselves."""
    return (F.col("__n_words") < MIN_WORDS) | (F.lit(100) * F.col("__n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("__n_words"))


def rule_failures() -> dict[str, Column]:
    """The rules whose failures are counted by host."""
    return {
        "short": F.col("__n_words") < MIN_WORDS,
        "repeats": F.lit(100) * F.col("__n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("__n_words"),
        "symbols": F.col("__n_symbols") > F.col("__n_words"),
        "dup_lines": F.col("__n_dup_lines") * 20 > F.col("__n_words"),
        "word_length": (F.col("__word_chars") > 15 * F.col("__n_words")) | (F.col("__word_chars") < 2 * F.col("__n_words")),
    }


def host_verdicts(measured: DataFrame, host: str, limit: float = HOST_RATE) -> DataFrame:
    """One row per host: documents, shrunk failure rate of each rule, ``host_failed``.

    Prior of a rule: mean ``m`` of the failures over all documents; the spread of the
    hosts' rates beyond what binomial sampling explains gives the prior's weight
    ``s = m (1 - m) / between - 1`` (moments; a spread of nothing gives the weight of
    all documents, i.e. hosts differ by chance alone). Shrunk rate of a host with k of
    n failing: ``(k + m s) / (n + s)``.
    """
    rules = rule_failures()
    by_host = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"), *(F.sum(c.cast("long")).alias(f"k_{r}") for r, c in rules.items()))
    n = F.col("host_docs")
    sums = [F.sum(n).alias("all_n"), F.sum(n * n).alias("all_n2"), F.count(F.lit(1)).alias("hosts")]
    for r in rules:
        sums += [F.sum(f"k_{r}").alias(f"all_{r}"), F.sum((F.col(f"k_{r}") * F.col(f"k_{r}")) / n).alias(f"sq_{r}")]
    by_host = stored(by_host, "hosts")
    total = by_host.agg(*sums).first().asDict()  # one row, of sums
    out = by_host.select("*", *(F.lit(v).cast("double" if k.startswith("sq_") else "long").alias(k) for k, v in total.items()))
    rates = []
    for r in rules:
        m = F.col(f"all_{r}") / F.col("all_n")
        # weighted variance of the hosts' rates (analysis of variance, one way)
        spread = F.col(f"sq_{r}") - F.col(f"all_{r}") * m
        within = (F.col(f"all_{r}") - F.col(f"sq_{r}")) / F.greatest(F.col("all_n") - F.col("hosts"), F.lit(1))
        per = F.col("all_n") - F.col("all_n2") / F.col("all_n")
        between = F.when(per > 0, (spread - (F.col("hosts") - 1) * within) / per)
        s = F.when(between > 0, F.greatest(m * (1 - m) / between - 1, F.lit(0.0))).otherwise(F.col("all_n").cast("double"))
        rates.append(((F.col(f"k_{r}") + m * s) / (n + s)).alias(f"rate_{r}"))
    out = out.select("host", "host_docs", *rates)
    failed = F.lit(False)
    for r in rules:
        failed = failed | (F.col(f"rate_{r}") > limit)
    return out.withColumn("host_failed", failed)


def quality_rules(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: id, host, the measures, ``base_failed``, the host's shrunk rates,
    ``host_failed`` and ``kept``."""
    named = docs.select(F.col(id).alias("__id"), F.col(host).alias("__host"), F.col(text).alias("__text"))
    m = stored(measure_documents(named, "__text", ["__id", "__host"]), "quality")  # read twice
    hosts = host_verdicts(m, "__host")
    j = m.join(hosts, F.col("__host").eqNullSafe(F.col("host")), "left")
    return j.select(
        F.col("__id").alias("doc_id"), *(F.col(f"__{c}").alias(c) for c in MEASURES),
        base_failed().alias("base_failed"), (~base_failed() & ~F.col("host_failed")).alias("kept"),
        F.col("__host").alias("host"), "host_docs", "host_failed", *(c for c in hosts.columns if c.startswith("rate_")))


@plain_names("text", "host")
def filter_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows that pass, with the columns they came with. The measures are made twice
    (once for the hosts, once beside the text), which costs less than shuffling texts."""
    hosts = host_verdicts(measure_documents(docs.select(host, text), text, [host]), host)
    bad = stored(hosts.filter("host_failed").select(F.col("host").alias("__host")), "bad-hosts")
    good = measure_documents(docs, text).filter(~base_failed())
    return good.join(bad, F.col(host).eqNullSafe(F.col("__host")), "left_anti").select(*docs.columns)
