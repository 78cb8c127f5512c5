"""Spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced letter parts them. Bigrams
are ordered by how many words hold them, rarest first. The prefix of a word is its
three first bigrams in that order: one edit touches two bigrams at most. Of the
prefix two disjoint bigrams with the least total count, found by dynamic
programming, are the word's pivots; one edit leaves one of them whole. The order
of surviving bigrams is the same in both words, so a surviving pivot of one word
is in the prefix of the other, this way round or the other way round.

Position limits make the index keys long. An edit behind a bigram leaves it in its
place, with all letters before it; and of the letters behind it, either the first
half or those after that half, which the edit moves by the difference in length. An
edit before the bigram is the mirror image. So a key is a bigram with one whole side
and half of the other, and the length of the word on the prefix' side; the pivots'
side makes a key for each length that a partner may have. Meetings are verified by
their edit distance.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import small_arrow_batches, stored

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
GRAM = 2
PREFIX = GRAM + 1         # one edit touches GRAM bigrams at most
COUNT_WORDS = 300_000     # words that a task counts before it passes them on
KEY_ROWS = 20_000


def count_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = MIN_LENGTH, leave_out: int | None = None) -> DataFrame:
    """(word, n): the maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF of
    at least ``min_length`` code points, A-Z lower-cased, with their occurrences.

    With ``leave_out``, a run whose CRC-32 of ``<id>:<word>`` it divides loses the
    letter at that number modulo its length; too short ones go. Null texts hold no
    word; a null id is the text ``null`` there. Tasks add up what they count and
    hold at most some 300,000 words at once."""
    letters = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"])

        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                # lower() of bytes changes A-Z alone
                words = letters.findall((text.as_py() or "").encode().lower().decode())
                if leave_out is None:
                    total.update(words)
                    continue
                start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(words).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % leave_out == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1:]
                        if len(word) < min_length:
                            continue
                    total[word] += n
            if len(total) > COUNT_WORDS:
                yield passed()
                total.clear()
        if total:
            yield passed()

    small_arrow_batches(docs.sparkSession)
    return (docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def gram_order(words: DataFrame) -> dict[str, int]:
    """The bigrams of the words, the rarest first, as numbers from 0. The alphabet
    has 90 letters, so there are at most 8,100 of them at any size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for word in b.column(0).to_pylist():
                seen.update({word[i:i + GRAM] for i in range(len(word) - 1)})
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
            names=["gram", "n"])

    counts = (words.select("word").mapInArrow(run, "gram string, n long")
              .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    ordered = sorted(counts, key=lambda r: (r["n"], r["gram"]))
    return {r["gram"]: k for k, r in enumerate(ordered)}


def prefix_of(word: str, order: dict[str, int]) -> list[int]:
    """Starts of the word's first bigrams in the order (ties: the earlier one)."""
    at = sorted(range(len(word) - 1), key=lambda i: (order[word[i:i + GRAM]], i))
    return sorted(at[:PREFIX])


def pivots_of(starts: list[int], costs: list[int]) -> list[int]:
    """Two disjoint bigrams of least total cost among those that start at
    ``starts`` (rising); ties go to the earlier ones.

    best[c][k]: the least cost of c disjoint bigrams among the first k, and which."""
    best = [[(0, [])] * (len(starts) + 1)]
    for _ in range(2):
        row: list = [None]
        for k, (at, cost) in enumerate(zip(starts, costs, strict=True)):
            free = sum(s + GRAM <= at for s in starts[:k])      # those that end before it
            before = best[-1][free]
            take = None if before is None else (before[0] + cost, [*before[1], at])
            kept = row[-1]
            row.append(take if kept is None or (take is not None and take[0] < kept[0]) else kept)
        best.append(row)
    return best[2][-1][1]


def keys_of(word: str, starts: list[int], lengths: tuple[int, ...]) -> set[str]:
    """Keys of the bigrams at ``starts``, to meet words that are shorter by each of
    ``lengths``: the prefix' side asks for (0,), the pivots' side for (-1, 0, 1).
    A key is read forwards (<) or backwards (>)."""
    keys = set()
    for side, letters, ends in (("<", word, [i + GRAM for i in starts]),
                                (">", word[::-1], [len(word) - i for i in starts])):
        for end in ends:
            for more in lengths:
                other = len(word) - more
                half = (max(other - end, 0) + 1) // 2
                if min(len(word), other) >= end + half:
                    keys.add(f"{side}{letters[:end + half]}{other}")
                keys.add(f"{side}{letters[:end]}|{letters[end + half + more:]}{other}")
    return keys


def index_keys(words: DataFrame, order: dict[str, int], pivots: bool) -> DataFrame:
    """(word, n, key): the keys of each word's pivots, or of its whole prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                starts = prefix_of(word, order)
                if pivots:
                    starts = pivots_of(starts, [order[word[i:i + GRAM]] for i in starts])
                rows += [(word, n, k) for k in
                         keys_of(word, starts, (-1, 0, 1) if pivots else (0,))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows, strict=True)], names=["word", "n", "key"])

    small_arrow_batches(words.sparkSession, KEY_ROWS)
    return (words.select("word", "n").mapInArrow(run, "word string, n long, key string")
            .withColumn("key", F.xxhash64("key")))


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, n_other): all near words of each word, both ways round."""
    order = gram_order(words)
    left = index_keys(words, order, pivots=True).toDF("a", "an", "key")
    right = index_keys(words, order, pivots=False).toDF("b", "bn", "key")
    apart = F.length("a") - F.length("b")
    met = (left.join(right, "key")
           .where((F.col("a") != F.col("b")) & apart.between(-1, 1))
           .where(F.levenshtein("a", "b", 1) == 1))
    # a pair may meet by several keys and both ways round
    first = F.col("a") < F.col("b")
    once = met.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"),
                      F.when(first, F.col("an")).otherwise(F.col("bn")).alias("an"),
                      F.when(first, F.col("b")).otherwise(F.col("a")).alias("b"),
                      F.when(first, F.col("bn")).otherwise(F.col("an")).alias("bn")).distinct()
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"),
                                      F.col("bn").alias("n_other")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("other"),
                                      F.col("an").alias("n_other"))))
    return once.select(both.alias("x")).select("x.*")


def _roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root): where the forms of ``links`` (word, form) end. Each step
    multiplies n by ``ratio`` at least, so the steps are few; each round doubles
    how far a word sees."""
    steps = max(1, math.floor(math.log(max(most, 1), ratio)) + 1)
    seen = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = seen.select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = stored(seen.join(further, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root")), "variant-roots")
    return seen


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Words with their near words and the form that each is a variant of.

    ``words`` holds distinct words (word, n) of at least four of the letters a-z
    and U+00C0 to U+00FF. One row per word: form (the near word of the largest n,
    ties to the smallest in code-point order, if that n is at least ``ratio``
    times the word's; else null), root (where following forms ends; the word
    itself without one), n, n_near (near words), form_n (n of the form).

    Words alike in all but one letter are grouped whatever their number; no words
    give no rows; columns other than these two are ignored."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = stored(words.select("word", "n"), "variant-words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("n_other")).alias("less"), "other")).alias("top"))
    form_n = -F.col("top.less")
    big = form_n >= F.col("n") * ratio
    found = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(big, F.col("top.other")).alias("form"),
        F.when(big, form_n).alias("form_n")), "variant-forms")
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(found.where("form is not null"), most, ratio)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, leave_out: int | None = None) -> DataFrame:
    """``group_variants`` of the runs of letters in a table of texts that occur at
    least ``min_count`` times; see there and ``count_runs``."""
    if min_length < GRAM + 2:
        raise ValueError("words need three bigrams: min_length must be 4 or more")
    words = count_runs(docs, id_col, text_col, min_length, leave_out)
    return group_variants(words.where(F.col("n") >= min_count), ratio)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
