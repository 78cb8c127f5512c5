"""Stupid-backoff scores from n-gram counts of the whole corpus.

Documents are read in chunks, which are dealt out once. A chunk sends each of its
distinct n-grams with its count to the bucket that owns the n-gram's hash; a bucket
adds up the counts of all chunks and answers a chunk with the totals that differ
from its own counts, by their place among what the chunk sent. Most long n-grams
occur in one chunk only and need no answer. This is a hash join of the count table
with the exploded n-grams whose rows travel as arrays, counted before they are
shuffled, so a very common n-gram costs one entry per chunk. Each chunk then scores
its documents by the counts of all others: a document's own occurrences are
taken off.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import mix64, small_arrow_batches, stored
from farebox.llm.jaccard_join import _numbers

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 1              # n-grams of two and more words below this count as unseen
CHUNK_WORDS = 1_000_000    # a chunk ends with the document that reaches this
BUCKET_ENTRIES = 1_000_000  # about so many counts of chunks meet in a bucket
BYTES_A_WORD = 6
KEY_BITS = 56              # words and n-grams are told apart by so many bits of a hash


def planes(x: np.ndarray) -> bytes:
    """Numbers as their first bytes, then their second bytes and so on, compressed:
    the empty upper bytes of small numbers lie together and come to nothing."""
    flat = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(flat).to_bytes(8, "little") + pa.compress(flat, codec="zstd", asbytes=True)


def unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    flat = np.frombuffer(plain, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def steps(x: np.ndarray) -> bytes:
    """Sorted unsigned numbers as their differences."""
    return planes(np.diff(x, prepend=np.uint64(0)))


def unsteps(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)


def ngrams(words: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each word, and whether one does: an
    n-gram lies within one document (``ends`` are the documents' ends)."""
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(words)) - np.repeat(starts, ends - starts)
    there = place >= n - 1
    h = np.full(len(words), n, np.uint64)
    for back in range(n - 1, -1, -1):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + np.roll(words, back))
    return h >> np.uint64(64 - KEY_BITS), there


def _distinct(h: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of one order with their counts, and the place of every
    word's n-gram among them (-1: none ends there)."""
    keys, back, counts = np.unique(h[there], return_inverse=True, return_counts=True)
    places = np.full(len(h), -1)
    places[there] = back
    return keys, counts, places


def _marks(keys: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of sorted hashes, by their first bits, and where each begins."""
    buckets, at = np.unique(keys >> np.uint64(shift), return_index=True)
    return buckets.astype(np.int64), np.append(at, len(keys))


def own_counts(places: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """How often the n-gram that ends at a word occurs in the word's document."""
    out = np.zeros(len(places), np.int64)
    there = np.nonzero(places >= 0)[0]
    if len(there):
        _, back, n = np.unique(documents[there] * (int(places.max()) + 1) + places[there],
                               return_inverse=True, return_counts=True)
        out[there] = n[back]
    return out


def score_words(counts: list[np.ndarray], usable: list[np.ndarray], alpha: float = ALPHA,
                min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """Log score of every word, by the longest n-gram that is seen often enough over
    its context, alpha for every order stepped down; and whether it is a single
    word's count, which is still to be divided by the number of all words."""
    out = np.log(np.maximum(counts[0], 1))
    single = np.ones(len(out), bool)
    for n in range(2, len(counts) + 1):
        c, context = counts[n - 1], np.roll(counts[n - 2], 1)
        seen = usable[n - 1] & (c >= max(min_count, 1))
        up = np.log(np.maximum(c, 1) / np.maximum(context, 1))
        out = np.where(seen, up, np.where(usable[n - 1], out + np.log(alpha), out))
        single &= ~seen
    return out, single


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
             alpha: float = ALPHA, min_count: int = MIN_COUNT, leave_own: bool = True,
             chunk_words: int = CHUNK_WORDS, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per input row: doc_id, n_words, log_score (sum over the words),
    mean_log_score (null without words).

    Words are parted by white space; counts cover all rows, each repeated row
    too. With ``leave_own`` the n-grams of a row are counted in all other rows,
    else in its own as well. A word that is counted nowhere scores as if it were
    once. Null and empty texts have no words and score 0; null ids are kept; an
    empty table gives none; other columns are ignored."""
    small_arrow_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    bits = max(0, int(size * order // (BYTES_A_WORD * bucket_entries))).bit_length()
    shift = KEY_BITS - bits

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = (TaskContext.get().partitionId()) << 32
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = _numbers((t.as_py() or "").split()) >> np.uint64(64 - KEY_BITS)
                ids.append(i)
                texts.append(w)
                size += len(w)
                if size >= chunk_words:
                    yield _chunk_row(chunk, ids, texts)
                    chunk, ids, texts, size = chunk + 1, [], [], 0
        if ids:
            yield _chunk_row(chunk, ids, texts)

    # both uses below ask for all columns, so they share one exchange
    chunks = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        pack, "chunk long, ids array<long>, ends binary, vocab binary, numbers binary, words binary"
    ).repartition("chunk")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                words, ends = _unpack(b, k)
                for n in range(1, order + 1):
                    keys, counts, _ = _distinct(*ngrams(words, ends, n))
                    buckets, at = _marks(keys, shift)
                    cuts = list(zip(at, at[1:], strict=False))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(buckets), pa.array([b.column(0)[k].as_py()] * len(buckets),
                                                    pa.int64()),
                        pa.array([n] * len(buckets), pa.int32()),
                        pa.array([steps(keys[a:z]) for a, z in cuts], pa.binary()),
                        pa.array([planes(counts[a:z].astype(np.uint32)) for a, z in cuts],
                                 pa.binary())], names=["bucket", "chunk", "n", "keys", "counts"])

    def total(table: pa.Table) -> pa.Table:
        keys = [unsteps(x.as_py()) for x in table.column("keys")]
        counts = [unplanes(x.as_py(), np.uint32).astype(np.int64) for x in table.column("counts")]
        _, back = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(back, np.concatenate(counts)).astype(np.int64)[back]
        marks = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
        rows = []
        for k, own in enumerate(counts):
            theirs = sums[marks[k]:marks[k + 1]]
            at = np.nonzero(theirs != own)[0]
            rows.append((steps(at.astype(np.uint64)), planes(theirs[at])) if len(at) else None)
        some = pa.array([r is not None for r in rows])
        named = table.select(["chunk", "n", "bucket"]).filter(some)
        kept = [r for r in rows if r is not None]
        for c, name in enumerate(("at", "sums")):
            named = named.append_column(name, pa.array([r[c] for r in kept], pa.binary()))
        return named

    sent = chunks.mapInArrow(send, "bucket long, chunk long, n int, keys binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(
        total, "chunk long, n int, bucket long, at binary, sums binary")
    by_chunk = answers.groupBy("chunk").agg(
        F.collect_list(F.struct("n", "bucket", "at", "sums")).alias("answers"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                words, ends = _unpack(b, k)
                starts = np.concatenate([[0], ends[:-1]])
                documents = np.repeat(np.arange(len(ends)), ends - starts)
                got = {(a["n"], a["bucket"]): (a["at"], a["sums"])
                       for a in b.column("answers")[k].as_py() or []}
                counts, usable = [], []
                for n in range(1, order + 1):
                    keys, sums, places = _distinct(*ngrams(words, ends, n))
                    for bucket, first in zip(*_marks(keys, shift), strict=False):
                        if (n, bucket) in got:
                            at, more = got[n, bucket]
                            sums[first + unsteps(at).astype(np.int64)] = unplanes(more, np.int64)
                    c = np.where(places >= 0, sums[places], 0) if len(sums) else np.zeros(
                        len(places), np.int64)
                    counts.append(c - own_counts(places, documents) if leave_own else c)
                    usable.append(places >= 0)
                each, single = score_words(counts, usable, alpha, min_count)
                upto = np.concatenate([[0.0], np.cumsum(each)])
                singles = np.concatenate([[0], np.cumsum(single)])
                yield pa.RecordBatch.from_arrays([
                    b.column("ids")[k].values, pa.array(ends - starts, pa.int64()),
                    pa.array(upto[ends] - upto[starts]),
                    pa.array(singles[ends] - singles[starts], pa.int64())],
                    names=["doc_id", "n_words", "part", "singles"])

    scored = stored(chunks.join(by_chunk, "chunk", "left").select(
        "chunk", "ids", "ends", "vocab", "numbers", "words", "answers").mapInArrow(
        finish, "doc_id long, n_words long, part double, singles long"), "lm-scored")
    all_words = scored.agg(F.sum("n_words")).first()[0] or 0
    others = F.lit(all_words) - (F.col("n_words") if leave_own else F.lit(0))
    log_score = F.col("part") - F.col("singles") * F.log(F.greatest(others, F.lit(1)))
    return scored.select("doc_id", "n_words", log_score.alias("log_score"), F.when(
        F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"))


def _chunk_row(chunk: int, ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
    """A chunk as one row: its words as numbers into its own vocabulary, in which
    frequent words come first, so that most numbers are small."""
    vocab, words, n = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    frequent = np.argsort(-n, kind="stable")
    number = np.empty(len(vocab), np.uint32)
    number[frequent] = np.arange(len(vocab), dtype=np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    return pa.RecordBatch.from_arrays([
        pa.array([chunk], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
        pa.array([planes(ends.astype(np.int64))], pa.binary()),
        pa.array([steps(vocab)], pa.binary()),
        pa.array([planes(number)], pa.binary()),
        pa.array([planes(number[words])], pa.binary())],
        names=["chunk", "ids", "ends", "vocab", "numbers", "words"])


def _unpack(b: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    get = lambda c: b.column(c)[k].as_py()
    vocab = np.empty_like(sorted_vocab := unsteps(get("vocab")))
    vocab[unplanes(get("numbers"), np.uint32)] = sorted_vocab
    return vocab[unplanes(get("words"), np.uint32)], unplanes(get("ends"), np.int64)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
