"""Byte-level BPE ids of many texts at once, each distinct piece encoded once.

A text is cut before each blank that follows a byte which cannot end white space. The
split pattern of byte-level BPE lets no match run over such a place and looks no
further back, so the pieces can be encoded apart. The pieces of a step are hashed
without making Python objects; those not met before are joined again and encoded by one
call of tiktoken's core; the bytes of the tokens tell which belong to which piece.

The split pattern looks ahead from white space, and its engine fails on runs of some
hundred thousand. Runs of ``LONG_RUN`` characters and more are therefore cut by its rule
here: all but the last character are one match, or all of them at the end of a text.
"""
from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np

from gatekit.llm.textops import U, ranges

#: Split pattern of byte-level BPE (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes that may end a white-space character: those of ASCII, and the last bytes of
#: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
_MAY_END_SPACE = np.zeros(256, bool)
_MAY_END_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x80, *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


#: White space as the split pattern has it (Unicode's property), in long runs.
LONG_RUN = 1000
_RUNS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)

#: Size of the table of pieces met before, and ids stored before it starts anew.
SLOT_BITS = 20
STORE_IDS = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A local rank file: lines of base64 bytes and a rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in ``tokenizers`` files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + i)] = b
    return out


def file_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``tokenizers`` byte-level BPE file whose merges stand in the order of
    their ids, which is checked merge by merge: the ids are the ranks then. Raises
    ValueError for any other file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    unusual = spec.get("normalizer") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
    if not plain or unusual:
        raise ValueError(f"not a plain byte-level BPE file: {path}")
    byte, special = _byte_of(), {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"].get(a + b, -1) for a, b in pairs]
    if min(ids, default=0) < 0 or any(x >= y for x, y in zip(ids, ids[1:])) or len(ids) + 256 != len(ranks):
        raise ValueError(f"its ids are not its merge ranks: {path}")
    return ranks


def file_specials(path: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` file, whose strings are single tokens wherever
    they stand in a text. Raises ValueError for those with rules about what is around them."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError(f"added tokens with rules: {path}")
    return {t["content"]: t["id"] for t in added}


class BatchEncoder:
    """Ids by merge ranks. ``specials``: strings that are one token where they stand in a
    text (as ``tokenizers`` has it for a file's added tokens); by default there are none,
    and such strings are ordinary text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, specials: dict[str, int] | None = None):
        import tiktoken

        self.specials = specials or {}
        names = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.special_bytes = re.compile(b"|".join(re.escape(n.encode()) for n in names)) if names else None

        self.cuts_runs = pattern == PATTERN
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        every = ranks | {name.encode(): i for name, i in self.specials.items()}
        self.size = np.zeros(max(every.values()) + 1, np.int64)
        self.token_bytes: list[bytes] = [b""] * len(self.size)
        for b, i in every.items():
            self.size[i] = len(b)
            self.token_bytes[i] = b
        self._forget()

    def _forget(self) -> None:
        """An empty store of ids, and an empty table (one piece per slot) over it."""
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.keys = np.zeros(1 << SLOT_BITS, U)
        self.off = np.zeros(1 << SLOT_BITS, np.int64)
        self.count = np.zeros(1 << SLOT_BITS, np.int64)

    def _keep(self, ids: np.ndarray) -> int:
        base, self.used = self.used, self.used + len(ids)
        while self.used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[base:self.used] = ids
        return base

    def text_ids(self, text: str) -> list[int]:
        """Ids of one text, whatever runs of white space it holds."""
        if len(text) < LONG_RUN or not self.cuts_runs:
            return self.encoding.encode_ordinary(text)
        ids, at = [], 0
        for run in _RUNS.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.encoding.encode_ordinary(text[at:run.start()])
            ids += self.encoding._encode_single_piece(text[run.start():end])
            at = end
        return ids + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)

    def _one(self, raw: bytes) -> list[int]:
        return self.text_ids(raw.decode("utf-8", "replace"))

    def _document(self, raw: bytes) -> list[int]:
        """One whole text, cut at the special strings first."""
        text = raw.decode("utf-8", "replace")
        if self.special is None:
            return self.text_ids(text)
        parts = self.special.split(text)  # a special string at every second place
        return [i for k, p in enumerate(parts) for i in ([self.specials[p]] if k % 2 else self.text_ids(p))]

    def _each(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = [self._document(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        return np.array([i for x in own for i in x], np.uint32), np.array([len(x) for x in own], np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents in a row, ids per document) of a step's bytes."""
        docs, n = len(offsets) - 1, len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(docs, np.int64)
        if self.special_bytes is not None and self.special_bytes.search(data.tobytes()):
            return self._each(data, offsets)
        cut = np.zeros(n, bool)
        cut[1:] = (data[1:] == 0x20) & ~_MAY_END_SPACE[data[:-1]]
        filled = offsets[:-1][offsets[1:] > offsets[:-1]]
        cut[filled] = True
        s = np.flatnonzero(cut)
        e = np.append(s[1:], n)
        first = np.searchsorted(s, offsets)  # pieces of document d: first[d]:first[d + 1]
        # pieces that can stand anywhere in a joined text: blank first, safe byte last
        loose = (data[s] != 0x20) | _MAY_END_SPACE[data[e - 1]]
        loose[first[:-1][np.diff(first) > 0]] = True  # a document's first piece
        h = ranges(data)(s, e)
        h ^= (e - s).astype(U) << U(40)
        where, count = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
        if self.used > STORE_IDS:
            self._forget()
        slot = (h >> U(64 - SLOT_BITS)).astype(np.int64)
        known = ~loose & (self.keys[slot] == h)
        where[known], count[known] = self.off[slot[known]], self.count[slot[known]]
        new = np.flatnonzero(~loose & ~known)
        uh, at, which = np.unique(h[new], return_index=True, return_inverse=True)
        us, ue = s[new[at]], e[new[at]]
        size = ue - us
        end = np.cumsum(size)
        joined = data[np.arange(end[-1] if len(end) else 0) + np.repeat(us - (end - size), size)].tobytes()
        try:
            got = np.array(self.text_ids(joined.decode("utf-8")), np.uint32)
        except UnicodeDecodeError:  # a text is no UTF-8: document by document
            return self._each(data, offsets)
        upto = np.searchsorted(np.cumsum(self.size[got]), end, side="left") + 1  # tokens up to each piece's end
        begin = np.concatenate([[0], upto[:-1]]) if len(upto) else upto
        base = self._keep(got)
        slot = (uh >> U(64 - SLOT_BITS)).astype(np.int64)
        self.keys[slot], self.off[slot], self.count[slot] = uh, base + begin, upto - begin
        where[new], count[new] = base + begin[which], (upto - begin)[which]
        own = [self._one(data[a:b].tobytes()) for a, b in zip(s[loose], e[loose])]
        lens = np.fromiter(map(len, own), np.int64, len(own))
        base = self._keep(np.fromiter((i for x in own for i in x), np.uint32, int(lens.sum())))
        where[loose], count[loose] = base + np.cumsum(lens) - lens, lens
        till = np.cumsum(count)
        ids = self.flat[np.arange(till[-1]) + np.repeat(where - (till - count), count)]
        total = np.concatenate([[0], till])
        return ids, total[first[1:]] - total[first[:-1]]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = PATTERN) -> BatchEncoder:
    """One encoder per process and file; the files lie on every machine."""
    if path.endswith(".tiktoken"):
        return BatchEncoder(read_ranks(path), pattern)
    return BatchEncoder(file_ranks(path), pattern, file_specials(path))
