"""SentencePiece BPE encoding by suffix-array matching, and decoding.

A text's normal form is a leading mark and its spaces as marks (U+2581). No piece has a mark after another
character, so ids never span the places before a run of marks, and a text's ids are those of its cuts
between them. A task handles the distinct cuts of a batch that it has not met before:

1. the cuts are concatenated (with separators) and indexed: a suffix array in the order of the first 16
   characters, the length of the longest piece;
2. every piece of the vocabulary is binary-searched for its range of occurrences;
3. all occurrences become edges, placed by position and length;
4. relaxation: every cut starts as single characters; in every round each cut takes its edge of highest
   score (leftmost of equals) that spans two neighbouring symbols, until it has none. That is the order in
   which the model's merges apply. Very long cuts are relaxed with a heap instead of rounds.

Characters that no piece covers become the bytes of their UTF-8 form.

Null texts are empty and have no ids; null and repeated doc_ids and repeated rows give a row each; extra
columns are dropped; an empty table gives an empty result; texts are read whole at any length.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import text_col
from oddsframe.llm.token_counts import expand

MARK = "▁"
BLOCK_CHARS = 4_000_000
INDEX_CHARS = 400_000  # characters that one suffix array indexes
INTERN_MAX = 1_000_000
LONG_CUT = 64
_CUT = re.compile(f"{MARK}+[^{MARK}]*")


class Model:
    """Pieces and scores of a model file; ids of single bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.piece = {sp.id_to_piece(i): i for i in plain}
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.longest = max(map(len, self.piece))
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.out: list[bytes] = [b""] * n
        for p, i in self.piece.items():
            self.out[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte):
            self.out[i] = bytes([b])


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def match(text: str, model: Model) -> np.ndarray:
    """``edge[position, length]``: the id of the piece found there, or -1."""
    wide, n = model.longest, len(text)
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    alphabet = np.unique(points)
    size = 1 if len(alphabet) < 253 else 4
    code = (np.searchsorted(alphabet, points) + 1).astype(f">u{size}")
    padded = np.concatenate((code, np.zeros(wide, dtype=code.dtype)))
    starts = np.lib.stride_tricks.sliding_window_view(padded, wide)[:n]
    keys = np.ascontiguousarray(starts).view(np.uint8).reshape(n, wide * size)
    keys = np.pad(keys, ((0, 0), (0, -keys.shape[1] % 8)))
    order = np.lexsort(keys.view(">u8").T[::-1])  # the suffix array
    sorted_ = np.ascontiguousarray(keys[order]).view(f"S{keys.shape[1]}").ravel()
    at = {int(c): i + 1 for i, c in enumerate(alphabet)}
    names, ids, lens = [], [], []
    for p, i in model.piece.items():
        spelled = [at.get(ord(c), 0) for c in p]
        if 0 not in spelled:
            names.append(np.array(spelled, dtype=code.dtype).tobytes())
            ids.append(i)
            lens.append(len(p))
    edge = np.full((n, wide + 1), -1, dtype=np.int32)
    if names:
        first = np.searchsorted(sorted_, np.array(names, dtype=sorted_.dtype), side="left")
        top = np.array([x + b"\xff" * (sorted_.dtype.itemsize - len(x)) for x in names], dtype=sorted_.dtype)
        count = np.searchsorted(sorted_, top, side="right") - first
        where = order[expand(first, count)]
        edge[where, np.repeat(lens, count)] = np.repeat(ids, count)
    return edge


def relax(edge: np.ndarray, start: np.ndarray, owner: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols ``(start, length, owner)`` of all cuts when no edge is left. ``start``: every
    character's place, ``owner``: its cut; both sorted."""
    length = np.ones(len(start), dtype=np.int64)
    wide = edge.shape[1] - 1
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(start):
        both = length[:-1] + length[1:]
        fits = (owner[:-1] == owner[1:]) & (both <= wide)
        found = np.where(fits, edge[start[:-1], np.minimum(both, wide)], -1)
        value = np.append(np.where(found >= 0, score[found], -np.inf), -np.inf)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        best = np.maximum.reduceat(value, first)
        n = np.diff(np.append(first, len(start)))
        live = np.repeat(best > -np.inf, n)
        if not live.all():
            done.append((start[~live], length[~live], owner[~live]))
        hits = np.flatnonzero(live & (value == np.repeat(best, n)))
        take = hits[np.append(True, owner[hits][1:] != owner[hits][:-1])] if len(hits) else hits  # the leftmost of each cut
        length[take] += length[take + 1]
        live[take + 1] = False
        start, length, owner = start[live], length[live], owner[live]
    if not done:
        return start, length, owner
    start, length, owner = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(start, kind="stable")
    return start[order], length[order], owner[order]


def relax_long(edge: np.ndarray, a: int, b: int, score: np.ndarray) -> list[tuple[int, int]]:
    """The same for one cut at places a to b, with a heap."""
    wide = edge.shape[1] - 1
    after, before, size = list(range(1, b - a + 1)), list(range(-1, b - a - 1)), [1] * (b - a)
    heap: list[tuple[float, int, int]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < b - a and (n := size[i] + size[after[i]]) <= wide and (e := edge[a + i, n]) >= 0:
            heapq.heappush(heap, (-score[e], i, n))

    for i in range(b - a):
        offer(i)
    while heap:
        _, i, n = heapq.heappop(heap)
        if not size[i] or after[i] >= b - a or size[i] + size[after[i]] != n:
            continue
        j = after[i]
        size[i], size[j], after[i] = n, 0, after[j]
        if after[j] < b - a:
            before[after[j]] = i
        offer(i)
        offer(before[i])
    return [(a + i, n) for i, n in enumerate(size) if n]


def encode_cuts(cuts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all cuts one after the other, and the number of each."""
    text = "\x00".join(cuts)
    n = np.array([len(c) for c in cuts], dtype=np.int64)
    first = np.cumsum(n + 1) - (n + 1)
    edge = match(text, model)
    short = n <= LONG_CUT
    start, size, owner = relax(edge, expand(first[short], n[short]), np.repeat(np.flatnonzero(short), n[short]), model.score)
    for c in np.flatnonzero(~short).tolist():
        more = np.array(relax_long(edge, int(first[c]), int(first[c] + n[c]), model.score), dtype=np.int64)
        start, size = np.concatenate((start, more[:, 0])), np.concatenate((size, more[:, 1]))
        owner = np.concatenate((owner, np.full(len(more), c)))
    order = np.argsort(start, kind="stable")
    start, size, owner = start[order], size[order], owner[order]
    ids = edge[start, size].astype(np.int32)
    bare = np.flatnonzero(ids < 0)  # single characters that no piece covers
    spelled = [[model.byte[x] for x in text[start[i]].encode("utf-8", "surrogatepass")] for i in bare.tolist()]
    each = np.ones(len(ids), dtype=np.int64)
    each[bare] = [len(x) for x in spelled]
    out = np.repeat(ids, each)
    if len(bare):
        out[out < 0] = np.concatenate(spelled)
    return out, np.bincount(owner, weights=each, minlength=len(cuts)).astype(np.int64)


class _Cuts(dict):
    """Cut -> number, with the ids of each once ``tables`` has been called."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.model, self.new = load(path), []
        self.flat, self.lens = [np.empty(0, dtype=np.int32)], [np.empty(0, dtype=np.int64)]

    def __missing__(self, cut: str) -> int:
        self[cut] = n = len(self)
        self.new.append(cut)
        return n

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = 0
        while at < len(self.new):
            end, chars = at, 0
            while end < len(self.new) and (end == at or chars < INDEX_CHARS):
                chars += len(self.new[end]) + 1
                end += 1
            flat, lens = encode_cuts(self.new[at:end], self.model)
            self.flat.append(flat)
            self.lens.append(lens)
            at = end
        self.new, self.flat, self.lens = [], [np.concatenate(self.flat)], [np.concatenate(self.lens)]
        lens = self.lens[0]
        return self.flat[0], lens, np.cumsum(lens) - lens


def cuts_of(text: str) -> list[str]:
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return _CUT.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in text.split(" ")]


def encode_texts(texts: list[str], known: _Cuts) -> tuple[np.ndarray, np.ndarray]:
    parts = [cuts_of(t) for t in texts]
    seen = np.fromiter((known[c] for p in parts for c in p), dtype=np.int64)
    flat, lens, starts = known.tables()
    n = lens[seen]
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    return flat[expand(starts[seen], n)], np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64)


def decode_ids(ids: list[int], model: Model) -> str:
    """The text of ids as the library gives it: pieces joined, marks as spaces, the leading one dropped."""
    raw = b"".join(map(model.out.__getitem__, ids)).decode("utf-8", "replace")
    return raw[1:] if raw[:1] == " " else raw


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32())), ("same_text", pa.bool_())])


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``(doc_id, n_ids, ids, same_text)`` per row; same_text: the ids decode to the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Cuts(model_file)
        for b in batches:
            texts, done = b.column("text").to_pylist(), 0
            while done < len(texts):
                end, chars = done, 0
                while end < len(texts) and (end == done or chars + len(texts[end]) <= BLOCK_CHARS):
                    chars += len(texts[end])
                    end += 1
                if len(known) > INTERN_MAX:
                    known = _Cuts(model_file)
                ids, n = encode_texts(texts[done:end], known)
                edge = np.concatenate(([0], np.cumsum(n)))
                same = [decode_ids(ids[a:z].tolist(), known.model) == t for a, z, t in zip(edge, edge[1:], texts[done:end])]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(done, end - done), pa.array(n),
                     pa.ListArray.from_arrays(edge.astype(np.int32), ids), pa.array(same)], schema=ENCODED)
                done = end

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text")).mapInArrow(
        run, "doc_id long, n_ids long, ids array<int>, same_text boolean")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``; null ids are an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_file)
        for b in batches:
            text = [decode_ids(x or [], model) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string")
