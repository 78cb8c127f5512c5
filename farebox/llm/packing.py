"""Packing by Karmarkar-Karp multiway differencing.

A document becomes its token ids plus one end id. Whole windows are cut off its
front; the rest is cut into equal parts of at most ``part`` ids. The parts of a
group of neighbouring documents are spread over W windows by differencing: the
two partial partitions with the largest imbalance are merged, the fullest bin of
one onto the emptiest of the other, until one partition is left. W starts at
the least possible count and rises whenever a window would exceed the capacity.

Groups are consecutive rows of an input partition, closed by their number or their
ids, so nothing is shuffled, one group is all a task holds, and a lost task repeats
its own rows only. Sequence
ids carry the partition number in their high bits and are unique.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import per_worker, small_arrow_batches

CAPACITY = 1024
PART = 256
GROUP_DOCS = 512
GROUP_IDS = 2_000_000     # a group ends with the document that reaches this
PACK_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
               "sequence_id long, offset long")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64())])


def difference(sizes: list[int], bins: int) -> list[list[int]]:
    """Spread ``sizes`` over ``bins`` near-equal bins; item numbers per bin.

    A partial partition is its non-empty bins, fullest first, as (sum, items
    tree); the bins it lacks are empty. Ties go to the older partition."""
    heap = [(-s, n, [(s, n)]) for n, s in enumerate(sizes)]
    heapq.heapify(heap)
    fresh = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = len(a) + len(b) - bins        # bins that must be shared
        if both > 0:
            # the fullest bins of both stay alone; of the others the fuller of
            # one take the emptier of the other
            shared = zip(a[len(a) - both:], reversed(b[len(b) - both:]), strict=True)
            a = a[:len(a) - both] + [(x + y, (m, n)) for (x, m), (y, n) in shared]
            b = b[:len(b) - both]
        merged = sorted(a + b, key=lambda e: -e[0])
        low = merged[-1][0] if len(merged) == bins else 0
        heapq.heappush(heap, (low - merged[0][0], fresh, merged))
        fresh += 1
    out = []
    for _, tree in (heap[0][2] if heap else []):
        items, todo = [], [tree]
        while todo:
            t = todo.pop()
            if isinstance(t, tuple):
                todo += t
            else:
                items.append(t)
        out.append(sorted(items))
    return out


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of at most ``capacity``; their count rises until every bin fits."""
    bins = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, bins)
        over = sum(max(0, sum(sizes[n] for n in b) - capacity) for b in found)
        if not over:
            return found
        bins += max(1, over // capacity)


class ByteBpe:
    """Ids of the byte-level vocabulary: exactly those of its tokenizer file."""

    def __init__(self, tokenizer_path: str):
        import json

        import tiktoken
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        points = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in points]
        byte = {chr(b): b for b in points} | {chr(256 + n): b for n, b in enumerate(rest)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in w): n for w, n in spec["model"]["vocab"].items()
                 if w not in self.special}
        pattern = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                   r"|\s+(?!\S)|\s+")
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    def encode(self, text: str) -> np.ndarray:
        if not self.special or not self.at_special.search(text):
            return self.encoding.encode_to_numpy(text, disallowed_special=())
        return np.concatenate([
            np.array([self.special[part]], np.uint32) if part in self.special
            else self.encoding.encode_to_numpy(part, disallowed_special=())
            for part in self.at_special.split(text)])


def _cut(n: int, capacity: int, part: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then equal parts."""
    whole = n // capacity * capacity
    out = [(s, capacity) for s in range(0, whole, capacity)]
    rest = n - whole
    if rest:
        count = -(-rest // part)
        marks = [whole + rest * k // count for k in range(count + 1)]
        out += [(a, b - a) for a, b in zip(marks, marks[1:], strict=False)]
    return out


def _pack_group(docs: list[tuple], first_seq: int, capacity: int, part: int
                ) -> tuple[pa.RecordBatch, int]:
    rows, loose = [], []
    seq = first_seq
    for doc_id, ids, tokens in docs:
        for start, length in _cut(tokens, capacity, part):
            piece = (doc_id, start, length, ids[4 * start:4 * (start + length)], tokens)
            if length == capacity:
                rows.append((*piece, seq, 0))
                seq += 1
            else:
                loose.append(piece)
    if loose:
        for window in windows([p[2] for p in loose], capacity):
            at = 0
            for n in window:
                rows.append((*loose[n], seq, at))
                at += loose[n][2]
            seq += 1
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW), seq


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, part: int = PART, end_id: int = 0) -> DataFrame:
    """One row per piece of a document: where it starts in the document, its
    ids (little-endian unsigned 32-bit numbers, as files of tokens hold them), its
    sequence and its offset there.

    A null or empty text is the single id ``end_id``; a null id is kept as null;
    repeated rows are packed once each; an empty table gives no rows; columns
    other than the two named are ignored, whatever their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = per_worker("byte_bpe " + tokenizer_path, lambda: ByteBpe(tokenizer_path))
        seq = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(bpe.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                held.append((doc_id, ids.tobytes(), len(ids)))
                size += len(ids)
                if len(held) >= GROUP_DOCS or size >= GROUP_IDS:
                    out, seq = _pack_group(held, seq, capacity, part)
                    held, size = [], 0
                    yield out
        if held:
            yield _pack_group(held, seq, capacity, part)[0]

    small_arrow_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, PACK_SCHEMA)


def with_ids_crc32(packed: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``: CRC-32 of the ids' bytes."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
