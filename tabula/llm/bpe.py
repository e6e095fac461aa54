"""Byte-level BPE by corpus-level merge replay.

The texts of one block are cut into pretokens (numpy, whole block at once),
the distinct pretokens are collected, and the merges are replayed over all of
them together: an inverted index maps every mergeable token pair to the
positions where it stands, the pairs are taken in rank order, and a merge
touches only its own positions and their two neighbours.

Results equal tiktoken's ``encode_ordinary`` for the same ranks and pattern.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

L, N, W, O = 0, 1, 2, 3  # letters, numbers, white space, other
#: Words whose ids a worker remembers between blocks (memory bound, not a cut).
KEEP = 400_000


@functools.lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point, from the same properties as the pattern."""
    table = np.full(0x110000, O, np.uint8)
    points = np.array([c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF], np.uint32)
    every = points.tobytes().decode("utf-32-le")
    for value, pattern in ((L, r"\p{L}+"), (N, r"\p{N}+"), (W, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[points[m.start():m.end()]] = value
    return table


def utf8(column) -> tuple[bytes, np.ndarray]:
    """All bytes of a string array (NULL counts as empty) and the n+1 offsets."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    _, offs, data = arr.buffers()
    offsets = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = data.to_pybytes()[offsets[0]:offsets[-1]] if data is not None and len(offsets) else b""
    return raw, offsets - (offsets[0] if len(offsets) else 0)


def byte_classes(b: np.ndarray) -> np.ndarray:
    """Class of the character that each byte of valid UTF-8 belongs to."""
    classes = char_classes()
    cls = classes[:256][b]
    lead = np.flatnonzero(b >= 0xC0)
    if len(lead):
        # classes of multi-byte characters, copied to their further bytes
        size = 2 + (b[lead] >= 0xE0) + (b[lead] >= 0xF0)
        for k in (2, 3, 4):
            at = lead[size == k]
            value = classes[code_points(b, at)]
            for j in range(k):
                cls[at + j] = value
    return cls


def code_points(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points whose first bytes stand at ``at``."""
    first = b[at].astype(np.int64)
    extra = (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
    cp = first & np.array([0x7F, 0x1F, 0x0F, 0x07])[extra]
    for j in (1, 2, 3):
        more = extra >= j
        cp[more] = (cp[more] << 6) | (b[at[more] + j] & 0x3F)
    return cp


def pretokens(raw: bytes, doc_offsets: np.ndarray) -> np.ndarray:
    """Byte offsets where pretokens start, plus the end of ``raw``.

    Equals the matches of ``public_tokenizers.PATTERN`` on each text apart:
    contractions, then runs of letters, numbers or other characters with one
    space before them, then white space (its last character before a
    non-space stands apart).
    """
    b = np.frombuffer(raw, np.uint8)
    n = len(b)
    if not n:
        return np.array([0], np.int64)
    cls = byte_classes(b)
    first = np.zeros(n + 1, bool)  # a text starts here
    first[doc_offsets] = True
    first[0] = first[n] = True
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    start |= first[:n]
    white = cls == W
    # the last white-space character before a non-space of the same text
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:n])
    # a plain space there belongs to the run that follows
    start[last[b[last] == 0x20] + 1] = False
    while (inner := (b[last] & 0xC0) == 0x80).any():
        last = last - inner
    start[last] = True
    # contractions: an apostrophe that starts a token, with its letters
    apo = np.flatnonzero((b == 0x27) & start)
    apo = apo[apo + 1 < n]
    apo = apo[(cls[apo + 1] == L) & ~first[apo + 1]]
    if len(apo):
        c1 = b[apo + 1]
        nxt = np.minimum(apo + 2, n - 1)
        c2 = np.where((apo + 2 < n) & ~first[nxt], b[nxt], 0)
        long = (((c1 == 0x72) | (c1 == 0x76)) & (c2 == 0x65)) | ((c1 == 0x6C) & (c2 == 0x6C))
        size = np.where(np.isin(c1, [0x73, 0x74, 0x6D, 0x64]), 1, np.where(long, 2, 0))
        apo, size = apo[size > 0], size[size > 0]
        start[apo + 1] = False
        rest = apo + 1 + size
        rest = rest[rest < n]
        # what is left of the letters is a token of its own
        start[rest[(cls[rest] == L) & ~first[rest]]] = True
    return np.append(np.flatnonzero(start), n)


class Words:
    """Distinct pretokens of a block with their token ids as one flat array."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray):
        self.ids, self.offsets = ids, offsets

    def expand(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words ``index`` one after another, and each word's length."""
        lengths = self.offsets[index + 1] - self.offsets[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        pos = np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(self.offsets[index], lengths)
        return self.ids[pos], lengths


def distinct_words(raw: bytes, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct pretokens and, for every pretoken, the number of its word."""
    if len(starts) < 2:
        return [], np.zeros(0, np.int64)
    arr = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1,
                                [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw)])
    enc = arr.dictionary_encode()
    return enc.dictionary.to_pylist(), enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Encoder:
    """Ranks of a vocabulary file with the replay over many words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.kept: dict[bytes, int] = {}
        self.store = Words(np.zeros(0, np.int32), np.zeros(1, np.int64))
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every cut of a token into two tokens is a mergeable pair
        pairs, made = [], []
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs.append((a << 32) | b)
                    made.append(i)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs = np.append(np.array(pairs, np.int64)[order], np.iinfo(np.int64).max)
        self.made = np.append(np.array(made, np.int64)[order], -1)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair is not mergeable."""
        key = (a << 32) | b
        i = np.searchsorted(self.pairs, key)
        return np.where((self.pairs[i] == key) & (a >= 0) & (b >= 0), self.made[i], -1)

    def one(self, word: bytes) -> list[int]:
        """One word alone: lowest rank first, leftmost among equals."""
        if word in self.ranks:
            return [self.ranks[word]]
        parts = [bytes([b]) for b in word]
        nxt, prev = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = []

        def push(i):
            j = nxt[i]
            if j < len(parts) and (r := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts)):
            push(i)
        while heap:
            _, i, la, lb = heapq.heappop(heap)
            j = nxt[i]
            if j >= len(parts) or parts[i] is None or parts[j] is None or len(parts[i]) != la or len(parts[j]) != lb:
                continue
            parts[i] += parts[j]
            parts[j] = None
            nxt[i] = nxt[j]
            if nxt[j] < len(parts):
                prev[nxt[j]] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
        return [self.ranks[p] for p in parts if p is not None]

    def encode_words(self, words: list[bytes]) -> Words:
        """Replay every merge in rank order over all words at once."""
        if not words:
            return Words(np.zeros(0, np.int64), np.zeros(1, np.int64))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        # one separator (-1) before, between and after the words
        ends = np.cumsum(sizes + 1)
        total = int(ends[-1]) + 1
        tok = np.full(total, -1, np.int64)
        where = np.arange(len(flat)) + np.repeat(np.arange(len(words)) + 1, sizes)
        tok[where] = self.single[flat]
        nxt = np.arange(1, total + 1)
        prev = np.arange(-1, total - 1)
        alive = np.ones(total, bool)
        # words that are tokens as a whole need no replay
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        first = ends - sizes  # position of a word's first byte
        done = np.flatnonzero((whole >= 0) & (sizes > 0))
        skip = np.repeat(whole >= 0, sizes)
        alive[where[skip]] = False
        tok[where[skip]] = -1
        tok[first[done]] = whole[done]
        alive[first[done]] = True
        irregular: list[np.ndarray] = []
        # inverted index: rank -> positions of its pairs
        p = where[~skip]
        r = self.rank(tok[p], tok[p + 1])
        p, r = p[r >= 0], r[r >= 0]
        order = np.argsort(r, kind="stable")
        p, r = p[order], r[order]
        cut = np.flatnonzero(np.diff(r)) + 1
        index: dict[int, list[np.ndarray]] = {}
        for rank_value, posting in zip(r[np.append(0, cut)] if len(r) else [], np.split(p, cut)):
            index[int(rank_value)] = [posting]
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            now = heapq.heappop(heap)
            postings = index.pop(now, None)
            if postings is None:
                continue
            p = postings[0] if len(postings) == 1 else np.unique(np.concatenate(postings))
            # still there, and still this pair?
            p = p[alive[p]]
            q = nxt[p]
            ok = self.rank(tok[p], tok[q]) == now
            p, q = p[ok], q[ok]
            if not len(p):
                continue
            if len(p) > 1 and (q[:-1] == p[1:]).any():
                # overlapping pairs such as a-a-a: left to right, every other one
                chain = np.append(False, q[:-1] == p[1:])
                idx = np.arange(len(p))
                head = np.maximum.accumulate(np.where(chain, -1, idx))
                keep = (idx - head) % 2 == 0
                p, q = p[keep], q[keep]
            after = nxt[q]
            tok[p] = now
            alive[q] = False
            nxt[p] = after
            prev[after] = p
            before = prev[p]
            left = np.concatenate([before, p])
            new = self.rank(tok[left], tok[nxt[left]])
            hit = new >= 0
            left, new = left[hit], new[hit]
            if not len(left):
                continue
            if (low := new <= now).any():
                # A pair made now ranks below the merge at hand: the order within
                # those words matters, so they are done one at a time at the end.
                irregular.append(np.searchsorted(first, left[low], side="right") - 1)
            if len(left) == 1:
                k = int(new[0])
                if k not in index:
                    index[k] = []
                    heapq.heappush(heap, k)
                index[k].append(left)
                continue
            order = np.argsort(new, kind="stable")
            left, new = left[order], new[order]
            cut = np.flatnonzero(new[1:] != new[:-1]) + 1
            bounds = [0, *cut.tolist(), len(new)]
            for a, b in zip(bounds[:-1], bounds[1:]):
                k = int(new[a])
                if k not in index:
                    index[k] = []
                    heapq.heappush(heap, k)
                index[k].append(left[a:b])
        live = alive & (tok >= 0)
        ids = tok[live]
        owner = np.searchsorted(first, np.flatnonzero(live), side="right") - 1
        counts = np.bincount(owner, minlength=len(words))
        offsets = np.append(0, np.cumsum(counts))
        if irregular:
            redo = np.unique(np.concatenate(irregular))
            pieces = np.split(ids, offsets[1:-1])
            for w in redo:
                pieces[w] = np.array(self.one(words[w]), np.int64)
            ids = np.concatenate(pieces)
            offsets = np.append(0, np.cumsum([len(x) for x in pieces]))
        return Words(ids, offsets)

    def lookup(self, words: list[bytes]) -> tuple[Words, np.ndarray]:
        """Ids of ``words`` by number; words met in earlier blocks are kept, at
        most ``KEEP`` of them, so only new ones are replayed."""
        if len(self.kept) > KEEP:
            self.kept, self.store = {}, Words(np.zeros(0, np.int32), np.zeros(1, np.int64))
        kept = self.kept
        new = [w for w in words if w not in kept]
        if new:
            got = self.encode_words(new)
            n = len(kept)
            kept.update(zip(new, range(n, n + len(new))))
            self.store = Words(np.append(self.store.ids, got.ids.astype(np.int32)),
                               np.append(self.store.offsets, self.store.offsets[-1] + got.offsets[1:]))
        return self.store, np.fromiter(map(kept.__getitem__, words), np.int64, len(words))

    def encode_block(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts of an Arrow string column, and the n+1 offsets."""
        raw, doc_offsets = utf8(column)
        starts = pretokens(raw, doc_offsets)
        words, index = distinct_words(raw, starts)
        known, number = self.lookup(words)
        ids, lengths = known.expand(number[index])
        token_at = np.append(0, np.cumsum(lengths))
        return ids, token_at[np.searchsorted(starts, doc_offsets)] if len(starts) > 1 else np.zeros_like(doc_offsets)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load_encoder(path: str) -> Encoder:
    """Encoder of a ``.tiktoken`` rank file (kept once per Python worker)."""
    with open(path, "rb") as f:
        return Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
