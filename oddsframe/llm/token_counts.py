"""Token counts without token ids: pieces are counted once per distinct pre-token.

1. One pass over the documents cuts every text into pre-tokens and counts them per document. Per
   block of documents it emits the documents' own rows and, for every hash bucket of pre-tokens, the
   bucket's distinct pre-tokens with the documents that hold them and how often (postings, as one
   compressed Arrow batch: a tenth of the bytes of plain rows).
2. Pre-tokens that spell a vocabulary entry are resolved in that pass against a table made from the
   vocabulary file; its size is fixed by the file (50,257 entries here), not by the data.
3. The postings are dealt by bucket. All postings of a pre-token meet in one task, which counts its
   pieces once, multiplies by the frequencies and sums per document of each block. However often a
   pre-token occurs, it is one entry per block, so no bucket is heavy.
4. The buckets' sums are dealt by block and added to the block's documents.

The cut into pre-tokens is the library's own. Texts are first cut before single spaces, which
always start a pre-token; each distinct cut is handed to the library once per task. Texts with other
white space go to it whole. A special string in a text is one token, as the library's default has it.

Null texts are empty (0 bytes, 0 tokens); null and repeated doc_ids and repeated rows give a row each;
extra columns are dropped; an empty table gives an empty result; texts are read whole at any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import text_col

LIMIT = 1024
BLOCK_CHARS = 8_000_000  # text held by one block of postings
INTERN_MAX = 1_000_000  # distinct cuts remembered by a task before it starts anew
_UNEVEN = ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
_WIDE = re.compile("[\x85\xa0  -     　]")


@lru_cache(maxsize=2)
def _load(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _entries(path: str) -> dict[str, int]:
    """Pieces of every vocabulary entry taken as a pre-token; as many rows as the file has."""
    tok = _load(path)
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    return {w: len(tok.model.tokenize(w)) for w in tok.get_vocab() if w not in special}


def _cuts(text: str, tok) -> list[str]:
    """Parts of a text between which a pre-token boundary always lies."""
    if not text:
        return []
    if any(w in text for w in _UNEVEN) or text[-1] == " " or not text.isascii() and _WIDE.search(text):
        return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]


class _Interned(dict):
    """Cut -> number; per cut its pre-tokens, per pre-token its pieces if it is a vocabulary entry."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tok, self.entries = _load(path), _entries(path)
        self.names: list[str] = []
        self.of_name: dict[str, int] = {}
        self.pieces: list[int] = []
        self.crc: list[int] = []
        self.flat: list[int] = []
        self.starts: list[int] = [0]

    def __missing__(self, cut: str) -> int:
        for name, _ in self.tok.pre_tokenizer.pre_tokenize_str(cut):
            at = self.of_name.get(name)
            if at is None:
                at = self.of_name[name] = len(self.names)
                self.names.append(name)
                self.pieces.append(self.entries.get(name, 0))
                self.crc.append(zlib.crc32(name.encode("utf-8")))
            self.flat.append(at)
        self[cut] = n = len(self.starts) - 1
        self.starts.append(len(self.flat))
        return n


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) if total else 0
    return np.arange(total) + shift


BUCKET = pa.schema([("pre_token", pa.string()), ("docs", pa.list_(pa.int32())), ("freqs", pa.list_(pa.int32()))])
ROWS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("body", pa.binary())])
DOCS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
SUMS = pa.schema([("n", pa.int64())])


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(body).read_next_batch()


def _block(number: int, ids: pa.Array, texts: list[str], known: _Interned, buckets: int) -> pa.RecordBatch:
    special = [t.content for t in known.tok.get_added_tokens_decoder().values()]
    n = len(texts)
    extra, n_cuts = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    cut_ids, cut_freqs = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for i, text in enumerate(texts):
        parts = [text]
        for s in special:
            if s in text:
                parts = [p for x in parts for p in x.split(s)]
        extra[i] = len(parts) - 1
        found = Counter(_cuts(parts[0], known.tok))
        for p in parts[1:]:
            found.update(_cuts(p, known.tok))
        n_cuts[i] = len(found)
        cut_ids.append(np.fromiter(map(known.__getitem__, found), dtype=np.int64, count=len(found)))
        cut_freqs.append(np.fromiter(found.values(), dtype=np.int64, count=len(found)))
    cuts, freqs, doc = np.concatenate(cut_ids), np.concatenate(cut_freqs), np.repeat(np.arange(n), n_cuts)
    starts, flat, pieces = (np.array(x, dtype=np.int64) for x in (known.starts, known.flat, known.pieces))
    lengths = starts[cuts + 1] - starts[cuts]
    pre = flat[expand(starts[cuts], lengths)]
    doc, freqs = np.repeat(doc, lengths), np.repeat(freqs, lengths)
    n_known = extra + np.bincount(doc, weights=freqs * pieces[pre], minlength=n).astype(np.int64)
    n_bytes = pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64())
    out = [(-1, _packed(pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(n_known)], schema=DOCS)))]
    open_ = pieces[pre] == 0
    bucket = np.array(known.crc, dtype=np.int64) % buckets
    key, inverse = np.unique((bucket[pre[open_]] * len(pieces) + pre[open_]) * n + doc[open_], return_inverse=True)
    if len(key):
        freq = np.bincount(inverse, weights=freqs[open_]).astype(np.int32)
        name, where = key // n, (key % n).astype(np.int32)
        edge = np.concatenate(([0], np.flatnonzero(np.diff(name)) + 1, [len(name)]))
        of = name[edge[:-1]] // len(pieces)
        names = [known.names[x] for x in (name[edge[:-1]] % len(pieces)).tolist()]
        cut = np.concatenate(([0], np.flatnonzero(np.diff(of)) + 1, [len(of)])).tolist()
        for a, b in zip(cut, cut[1:]):
            at = (edge[a:b + 1] - edge[a]).astype(np.int32)
            span = slice(edge[a], edge[b])
            out.append((int(of[a]), _packed(pa.RecordBatch.from_arrays(
                [pa.array(names[a:b]), pa.ListArray.from_arrays(at, where[span]),
                 pa.ListArray.from_arrays(at, freq[span])], schema=BUCKET))))
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in out], pa.int64()), pa.array([number] * len(out), pa.int64()),
         pa.array([x for _, x in out], pa.binary())], schema=ROWS)


def _postings(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at = _Interned(path), TaskContext.get().partitionId() << 32
        for b in batches:
            texts = b.column("text").to_pylist()
            done = 0
            while done < len(texts):
                end, chars = done, 0
                while end < len(texts) and (end == done or chars + len(texts[end]) <= BLOCK_CHARS):
                    chars += len(texts[end])
                    end += 1
                if len(known) > INTERN_MAX:
                    known = _Interned(path)
                yield _block(at, b.column("doc_id").slice(done, end - done), texts[done:end], known, buckets)
                at, done = at + 1, end
    return run


class _Pieces(dict):
    """Pre-token -> pieces, each counted once."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.model = _load(path).model

    def __missing__(self, name: str) -> int:
        self[name] = n = len(self.model.tokenize(name))
        return n


def _joined(path: str):
    """Per bucket and block: the tokens that the bucket's pre-tokens add to each document. A block's
    own rows (bucket -1) pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(path)
        for b in batches:
            bodies = []
            for bucket, body in zip(b.column("bucket").to_pylist(), b.column("body").to_pylist()):
                if bucket >= 0:
                    rows = _unpacked(body)
                    docs, freqs = rows.column("docs"), rows.column("freqs")
                    each = np.array([pieces[x] for x in rows.column("pre_token").to_pylist()], dtype=np.int64)
                    weight = np.repeat(each, np.diff(docs.offsets.to_numpy())) * freqs.values.to_numpy()
                    sums = np.bincount(docs.values.to_numpy(), weights=weight).astype(np.int64)
                    body = _packed(pa.RecordBatch.from_arrays([pa.array(sums)], schema=SUMS))
                bodies.append(body)
            yield pa.RecordBatch.from_arrays([b.column("bucket"), b.column("block"), pa.array(bodies, pa.binary())],
                                             schema=ROWS)
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, a block's own row first: the block's documents with all sums added."""
    held = total = None
    for b in batches:
        for bucket, body in zip(b.column("bucket").to_pylist(), b.column("body").to_pylist()):
            if bucket < 0:
                if held is not None:
                    yield held.set_column(2, "n_tokens", pa.array(total))
                held = _unpacked(body)
                total = held.column("n_tokens").to_numpy(zero_copy_only=False).copy()
            else:
                more = _unpacked(body).column("n").to_numpy()
                total[:len(more)] += more
    if held is not None:
        yield held.set_column(2, "n_tokens", pa.array(total))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, buckets: int | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row; ``vocabulary`` is the path of a byte-level
    BPE file of the ``tokenizers`` library, readable on every executor. ``buckets``: hash buckets of
    pre-tokens, twice the session's shuffle partitions unless given."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = "bucket long, block long, body binary"
    held = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text"))
            .mapInArrow(_postings(vocabulary, buckets or 2 * parts), fields))
    deal = F.when(F.col("bucket") < 0, F.col("block")).otherwise(F.col("bucket"))
    sums = held.repartition(parts, deal).mapInArrow(_joined(vocabulary), fields)
    done = (sums.repartition(parts, "block").sortWithinPartitions("block", "bucket")
            .mapInArrow(_added, "doc_id long, n_bytes long, n_tokens long"))
    return done.withColumn("over_limit", F.col("n_tokens") > limit)
