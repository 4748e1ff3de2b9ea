"""Order-preserving packing of token streams into windows of at most ``width`` tokens.

Each task turns its documents, in the order in which they come, into one stream of ids with
an end id after every document, and cuts it into consecutive windows by dynamic programming. Cuts
may fall at document ends (free), at sentence ends (``sentence_cost``) and, where a stretch
longer than ``stretch`` tokens has neither, or near the end of the stream, at any multiple of
``stretch`` (``hard_cost``). A window costs its padding plus its cut plus ``window_cost``:

    f(j) = cut(j) + window_cost + min over i in [j - width, j) of f(i) + width - (j - i)

whose minimum over a sliding range of ``f(i) + i`` is kept in a monotone queue. A window whose length
is a power of two (``SHORTEST`` or more) needs no padding; those few transitions are looked up besides the
queue.

A task's stream is cut in segments of about ``SEGMENT`` tokens: the cuts of a segment but for its
last windows are final, the rest goes on into the next segment, so memory is bounded. Streams of
different tasks are independent; sequence ids hold the task's number in their upper bits.

Null texts are empty (the end id only); empty texts are one token; null and repeated doc_ids and
repeated rows are packed row by row; a document of any length spans as many windows as it needs; extra
columns are dropped; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import text_col
from oddsframe.llm.token_counts import expand

WIDTH = 4096
SENTENCE_COST, HARD_COST, WINDOW_COST = 2, 24, 16
STRETCH = 128
SHORTEST = 64  # windows of a smaller power of two are not looked for
SEGMENT = 1 << 20
BLOCK_CHARS = 4_000_000
INTERN_MAX = 1_000_000


@lru_cache(maxsize=2)
def _load(path: str):
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class _Words(dict):
    """Word (a run without space and newline) -> number, with the ids of each. Ids never span such
    white space, so a text's ids are its words' ids one after the other. Number 0 ends a document.

    A run of lower-case Latin-1 letters is one pre-token, so the model is asked directly; letters
    followed by one mark are two pre-tokens; all else goes through the whole tokenizer."""

    def __init__(self, path: str, end_id: int) -> None:
        super().__init__()
        self.tok = _load(path)
        letters = [c for c in map(chr, range(256)) if c.isalpha() and c == c.lower()]
        self.bytes_of = {ord(c): "".join(w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(c)) for c in letters}
        self.letters = frozenset(letters)
        self.special = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.marks = {c: self.tok.encode(c, add_special_tokens=False).ids for c in ",.!?"}
        self.flat, self.lens, self.ends = array("I", [end_id]), array("I", [1]), bytearray([1])

    def ids(self, word: str) -> list[int]:
        if self.letters.issuperset(word):
            return [t.id for t in self.tok.model.tokenize(word.translate(self.bytes_of))] if word else []
        if word[-1] in ",.!?" and self.letters.issuperset(word[:-1]):
            return self.ids(word[:-1]) + self.marks[word[-1]]
        return self.tok.encode(word, add_special_tokens=False).ids

    def __missing__(self, word: str) -> int:
        found = self.ids(word)
        self[word] = n = len(self.ends)
        self.flat.extend(found)
        self.lens.append(len(found))
        self.ends.append(word == "\n" or word[-1:] in (".", "!", "?"))
        return n

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lens = np.array(self.lens, dtype=np.int64)
        return np.array(self.flat, dtype=np.uint32), lens, np.cumsum(lens) - lens, np.array(self.ends, dtype=bool)


def _lower(text: str, special: tuple[str, ...] = ()) -> str:
    """The library lower-cases each character by itself; for Latin-1 texts so does ``str.lower``.
    Done before words are looked up, it halves the distinct words. Other texts are left to the library, and so
    are those that hold a ``special`` string in any case: the library looks for these before it lower-cases."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    low = text.lower()
    return text if any(s in low or s in text for s in special) else low


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def tokenise(texts: list[str], words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts with the end id after each, the tokens of each, and the positions after
    which a sentence ends."""
    seen, counts = [], []
    for t in texts:
        parts = _lower(t, words.special).replace("\n", " \n ").split(" ") if t else []
        seen.append(np.fromiter(map(words.__getitem__, parts), dtype=np.int64, count=len(parts)))
        seen.append(np.zeros(1, dtype=np.int64))
        counts.append(len(parts) + 1)
    word = np.concatenate(seen)
    flat, lens, starts, ends = words.tables()
    n = lens[word]
    ids, stop = flat[expand(starts[word], n)], np.cumsum(n)
    doc_end = stop[np.cumsum(counts) - 1]
    return ids, np.diff(doc_end, prepend=0), _distinct(stop[ends[word]])


def candidate_cuts(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, *, width: int = WIDTH,
                   stretch: int = STRETCH, sentence_cost: int = SENTENCE_COST, hard_cost: int = HARD_COST,
                   last: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cut positions (0 and ``total`` among them) and the cost of each."""
    soft = _distinct(np.concatenate(([0, total], doc_ends, sentence_ends)))
    soft = soft[(soft >= 0) & (soft <= total)]
    gaps = np.diff(soft)
    wide = gaps > stretch
    more = (gaps[wide] - 1) // stretch
    hard = np.repeat(soft[:-1][wide], more) + (expand(np.ones(len(more), dtype=np.int64), more)) * stretch
    if last:
        hard = np.concatenate((hard, np.arange(total, max(0, total - 2 * width), -min(64, stretch))))
    at = _distinct(np.concatenate((soft, hard)))
    cost = np.full(len(at), hard_cost, dtype=np.int64)
    cost[np.isin(at, sentence_ends)] = sentence_cost
    cost[np.isin(at, doc_ends)] = 0
    cost[[0, -1]] = 0
    return at, cost


def best_cuts(at: np.ndarray, cost: np.ndarray, width: int = WIDTH, window_cost: int = WINDOW_COST) -> list[int]:
    """The cheapest choice of window ends among the candidate positions ``at``, as positions."""
    n = len(at)
    if n < 2:
        return []
    exact: dict[int, list[int]] = {}
    for k in range(SHORTEST.bit_length() - 1, width.bit_length()):
        i = np.searchsorted(at, at - (1 << k))
        for j in np.flatnonzero((at[np.minimum(i, n - 1)] == at - (1 << k)) & (np.arange(n) > 0)).tolist():
            exact.setdefault(j, []).append(int(i[j]))
    pos, cut = at.tolist(), cost.tolist()
    f, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f(i) + position, i), both rising
    for j in range(1, n):
        p = pos[j]
        while pos[queue[0][1]] < p - width:
            queue.popleft()
        key, i = queue[0]
        best = key + width - p
        for x in exact.get(j, ()):
            if f[x] < best:
                best, i = f[x], x
        f[j], back[j] = best + cut[j] + window_cost, i
        key = f[j] + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    ends, j = [], n - 1
    while j:
        ends.append(pos[j])
        j = back[j]
    return ends[::-1]


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("ids", pa.list_(pa.int32()))])


class _Stream:
    """A task's stream: documents go in, pieces of finished windows come out."""

    def __init__(self, width: int, with_ids: bool, first_sequence: int) -> None:
        self.width, self.with_ids, self.sequence = width, with_ids, first_sequence
        self.ids = np.empty(0, dtype=np.uint32)
        self.sentences = np.empty(0, dtype=np.int64)
        self.doc_ends = np.empty(0, dtype=np.int64)
        self.names: list[int | None] = []
        self.tokens: list[int] = []
        self.before = 0  # ids of the first document that earlier windows took

    def add(self, names: list, ids: np.ndarray, tokens: np.ndarray, sentences: np.ndarray) -> None:
        at = len(self.ids)
        self.doc_ends = np.concatenate((self.doc_ends, at + np.cumsum(tokens)))
        self.sentences = np.concatenate((self.sentences, at + sentences))
        self.ids = np.concatenate((self.ids, ids))
        self.names += names
        self.tokens += tokens.tolist()

    def cut(self, last: bool) -> pa.RecordBatch | None:
        total = len(self.ids)
        if not total:
            return None
        ends = best_cuts(*candidate_cuts(total, self.doc_ends, self.sentences, width=self.width, last=last), self.width)
        if not last:
            ends = [e for e in ends if e <= total - 2 * self.width]
        if not ends:
            return None
        edges = np.array(ends, dtype=np.int64)
        done = int(edges[-1])
        stops = _distinct(np.concatenate((edges, self.doc_ends[self.doc_ends <= done])))
        starts = np.concatenate(([0], stops[:-1]))
        doc = np.searchsorted(self.doc_ends, starts, side="right")
        window = np.searchsorted(edges, starts, side="right")
        doc_start = np.concatenate(([-self.before], self.doc_ends[:-1]))
        window_start = np.concatenate(([0], edges[:-1]))
        raw = np.ascontiguousarray(self.ids.astype("<u4"))
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
        ids = (pa.ListArray.from_arrays(np.concatenate((starts, [done])).astype(np.int32), raw[:done].view(np.int32))
               if self.with_ids else pa.nulls(len(stops), pa.list_(pa.int32())))
        out = pa.RecordBatch.from_arrays(
            [pa.array([self.names[d] for d in doc.tolist()], pa.int64()), pa.array(starts - doc_start[doc]),
             pa.array(stops - starts), pa.array(crc, pa.int64()),
             pa.array([self.tokens[d] for d in doc.tolist()], pa.int64()), pa.array(window + self.sequence),
             pa.array(starts - window_start[window]), ids], schema=PIECES)
        self.sequence += len(edges)
        gone = int(np.searchsorted(self.doc_ends, done, side="right"))
        left = doc_start[gone] if gone < len(doc_start) else done
        self.before = done - int(left)
        self.ids, self.doc_ends = self.ids[done:], self.doc_ends[gone:] - done
        self.sentences = self.sentences[self.sentences > done] - done
        self.names, self.tokens = self.names[gone:], self.tokens[gone:]
        return out


def pack(docs: DataFrame, vocabulary: str, end_id: int, width: int = WIDTH, with_ids: bool = True) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)``: ``length`` ids
    of a document from ``start`` lie in a sequence at ``offset``. ``with_ids`` False leaves ``ids`` null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(vocabulary, end_id)
        stream = _Stream(width, with_ids, TaskContext.get().partitionId() << 40)
        for b in batches:
            texts, names = b.column("text").to_pylist(), b.column("doc_id").to_pylist()
            done = 0
            while done < len(texts):
                end, chars = done, 0
                while end < len(texts) and (end == done or chars + len(texts[end]) <= BLOCK_CHARS):
                    chars += len(texts[end])
                    end += 1
                if len(words) > INTERN_MAX:
                    words = _Words(vocabulary, end_id)
                stream.add(names[done:end], *tokenise(texts[done:end], words))
                done = end
                if len(stream.ids) >= SEGMENT and (out := stream.cut(last=False)) is not None:
                    yield out
        if (out := stream.cut(last=True)) is not None:
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             "offset long, ids array<int>")
