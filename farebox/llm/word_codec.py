"""Encoding and decoding with a word vocabulary through a minimal automaton.

All words (runs without white space) of the table are counted; the frequent ones
become a minimal acyclic automaton over their bytes that shares suffixes. Each
edge carries how many words lie before it, so a traversal yields the number of a
word and with it its ids. The automaton is a few sorted arrays in one file, which
Spark hands to the executors and every worker maps into memory; a batch's distinct
words traverse it all at once. Words that it lacks are merged exactly: runs of
letters many at once, where the vocabulary parts them from the marks behind them,
and the rest by the tokenizer itself.
"""

from __future__ import annotations

import atexit
import json
import os
import re
import shutil
import string
import sys
import tempfile
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import per_worker, small_arrow_batches

LEXICON_WORDS = 200_000   # a word of the automaton holds at least this part of all bytes
LONGEST = 48              # bytes of the longest word in the automaton
CACHE_WORDS = 200_000     # odd words that a worker remembers, and as many of longer ago
MERGE_ROWS = 20_000       # runs of letters merged at once
BATCH_ROWS = 2500         # texts coded at once, unless their bytes end the batch before
COUNT_WORDS = 300_000     # words that a task counts before it passes them on
_PY_ONLY = "[\\x1c-\\x1f]"   # part words here, but not for the vocabulary
_LETTERS = "".join(c for c in map(chr, range(65, 256)) if c.isalpha() and c not in "\xaa\xb5\xba")
_SHAPE = re.compile(f"([{_LETTERS}]+)([{re.escape(string.punctuation)}]*)")


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Runs without white space, and the place among them where each text ends
    (with 0 in front)."""
    parts = pc.utf8_split_whitespace(texts)
    flat = parts.flatten()
    there = pc.not_equal(pc.binary_length(flat), 0)
    upto = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    return upto[parts.offsets.to_numpy()], flat.filter(there).dictionary_encode()


def _texts(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.string()), "")


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; tasks add up before anything is shuffled."""
    def added(seen: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(seen).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return t.rename_columns({"n_sum": "n"}).select(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.Table] = []
        for b in batches:
            _, words = words_of(_texts(b.column(0)))
            n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            seen.append(pa.table({"word": words.dictionary, "n": pa.array(n, pa.int64())}))
            if sum(map(len, seen)) > 2 * COUNT_WORDS:
                seen = [added(seen)]
                if len(seen[0]) > COUNT_WORDS:
                    yield from seen.pop().to_batches(COUNT_WORDS)
        if seen:
            yield from added(seen).to_batches(COUNT_WORDS)

    small_arrow_batches(docs.sparkSession, BATCH_ROWS)
    return (docs.select(F.col(text_col)).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def minimal_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Automaton of distinct sorted byte strings, states shared by equal futures.

    edge: state * 256 + byte, sorted; target and before (words that come earlier
    from that state) of each edge; final of each state."""
    register: dict[tuple, int] = {}
    edges: list[tuple] = []               # per minimal state: (final, ((byte, target), ...))
    path: list[list] = [[False, []]]      # of the word so far: [final, edges]

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(edges)
            edges.append(key)
        return register[key]

    last = b""
    for word in words:
        common = len(os.path.commonprefix([last, word]))
        while len(path) > common + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], freeze(node)))
    start = freeze(path[0])
    below = [0] * len(edges)              # targets are frozen before their sources
    rows = []
    for state, (final, out) in enumerate(edges):
        n = int(final)
        for byte, target in sorted(out):
            rows.append((state * 256 + byte, target, n))
            n += below[target]
        below[state] = n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 3)
    return {"edge": table[:, 0].copy(), "target": table[:, 1].copy(),
            "before": table[:, 2].copy(),
            "final": np.array([e[0] for e in edges], np.int64), "start": np.array([start])}


def traverse(auto: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Number of each word in sorted order, -1 where the automaton lacks it."""
    out = np.full(len(words), -1)
    sizes = np.array([len(w) for w in words])
    if not len(auto["edge"]):
        return out
    at = np.nonzero((sizes > 0) & (sizes <= LONGEST))[0]
    width = int(sizes[at].max(initial=0))
    chars = np.frombuffer(b"".join(words[k].ljust(width, b"\0") for k in at), np.uint8)
    chars = chars.reshape(len(at), width)
    state, number = np.full(len(at), auto["start"][0]), np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    for step in range(width + 1):
        done = sizes[at[live]] == step
        ends = live[done]
        hit = auto["final"][state[ends]] == 1
        out[at[ends[hit]]] = number[ends[hit]]
        live = live[~done]
        if not len(live):
            break
        want = state[live] * 256 + chars[live, step]
        where = np.minimum(np.searchsorted(auto["edge"], want), len(auto["edge"]) - 1)
        there = auto["edge"][where] == want
        live, where = live[there], where[there]
        number[live] += auto["before"][where]
        state[live] = auto["target"][where]
    return out


_PARTS = ("start", "edge", "target", "before", "final", "id_start", "ids")


def build_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
                  words: int = LEXICON_WORDS) -> str:
    """Make the automaton of the frequent words and give its file to Spark; the
    file's name there. Frequent are words whose occurrences make up at least a
    ``words``-th of all bytes, so there are at most ``words`` of them."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    share = F.col("n") * F.octet_length("word") * words
    rows = (count_words(docs, text_col)
            .where((F.octet_length("word") <= LONGEST) & (share >= total)).collect())
    tok = _tokenizer(tokenizer_path)
    special = _specials(tok)
    frequent = sorted(r["word"].encode() for r in rows
                      if not any(s in r["word"] for s in special))
    ids = [e.ids for e in tok.encode_batch([w.decode() for w in frequent],
                                           add_special_tokens=False)]
    auto = minimal_automaton(frequent)
    auto["id_start"] = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
    auto["ids"] = np.array(list(chain.from_iterable(ids)), np.int64)
    # the driver serves this file to every executor, later ones too, so its copy
    # stays until the driver ends
    folder = tempfile.mkdtemp(prefix="lexicon-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    with open(os.path.join(folder, name), "wb") as f:
        np.array([len(auto[p]) for p in _PARTS], np.int64).tofile(f)
        for p in _PARTS:
            auto[p].astype(np.int64).tofile(f)
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def load_lexicon(path: str) -> dict[str, np.ndarray]:
    """Arrays of a lexicon file, mapped into memory."""
    data = np.memmap(path, np.int64, "r")
    marks = np.concatenate([[0], np.cumsum(data[:len(_PARTS)])]) + len(_PARTS)
    return {p: data[marks[k]:marks[k + 1]] for k, p in enumerate(_PARTS)}


def _tokenizer(path: str):
    from tokenizers import Tokenizer
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _specials(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


def _parts_apart(tok) -> bool:
    """Whether the tokenizer parts letters from the ASCII marks that follow them
    before it merges, so that both may be merged on their own."""
    if tok.pre_tokenizer is None:
        return False
    cut = [[at for _, at in tok.pre_tokenizer.pre_tokenize_str(_LETTERS + marks)]
           for marks in (*string.punctuation, string.punctuation)]
    return all(len(c) == 2 and c[0] == (0, len(_LETTERS)) for c in cut)


def _ragged(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    at = np.repeat(start - (np.cumsum(size) - size), size)
    at += np.arange(len(at))
    return flat[at]


def _joined(ends: np.ndarray, strings: pa.Array) -> pa.Array:
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), strings)
    return pc.binary_join(lists, " ")


class Merges:
    """Exact byte-pair merges of many runs of letters at once.

    Runs are rows of a table of symbols. Every step merges, in each row, the
    leftmost pair of the lowest rank, as the tokenizer does one run at a time."""

    def __init__(self, symbols: np.ndarray, last: np.ndarray, merges: np.ndarray, base: int):
        self.symbols = symbols          # per Latin-1 letter up to two symbols, -1: none
        self.last = last                # the symbol that each one is at the end of a run
        self.base = base
        keys = merges[:, 0] * base + merges[:, 1]
        self.order = np.argsort(keys)   # rank of each key
        self.keys, self.made = keys[self.order], merges[self.order, 2]

    @classmethod
    def of(cls, tok) -> Merges | None:
        """From a tokenizer of plain byte-pair merges; None for any other."""
        model = json.loads(tok.to_str())["model"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback",
                                               "ignore_merges", "continuing_subword_prefix"))
        if model["type"] != "BPE" or not plain:
            return None
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        symbols, last = np.full((256, 2), -1), np.full(max(vocab.values()) + 1, -1)
        for c in _LETTERS:
            text = tok.normalizer.normalize_str(c) if tok.normalizer else c
            marks = "".join(p for p, _ in tok.pre_tokenizer.pre_tokenize_str(text))
            if not 1 <= len(marks) <= 2 or any(m not in vocab or m + end not in vocab for m in marks):
                return None
            symbols[ord(c), :len(marks)] = [vocab[m] for m in marks]
            for m in marks:
                last[vocab[m]] = vocab[m + end]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        rows = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        return cls(symbols, last, np.array(rows, np.int64).reshape(-1, 3), len(last))

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the keys, the number of keys for none."""
        want = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        there = (self.keys[at] == want) & (left >= 0) & (right >= 0)
        return np.where(there, at, len(self.keys))

    def merge(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all runs in some order; where each run's start, how many it has."""
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        flat, filled = [np.empty(0, np.int64)], 0
        start, count = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        by_size = np.argsort(sizes, kind="stable")
        by_size = by_size[sizes[by_size] > 0]
        for k in range(0, len(by_size), MERGE_ROWS):     # rows of like length
            rows = by_size[k:k + MERGE_ROWS]
            ids, n = self._merge([runs[r] for r in rows.tolist()], sizes[rows])
            start[rows], count[rows] = filled + np.cumsum(n) - n, n
            flat.append(ids)
            filled += len(ids)
        return np.concatenate(flat), start, count

    def _merge(self, runs: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(runs).encode("latin-1"), np.uint8)
        two = self.symbols[codes]
        there = two >= 0
        row = np.repeat(np.repeat(np.arange(len(runs)), sizes), there.sum(1))
        n = np.bincount(row, minlength=len(runs))
        column = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        table = np.full((len(runs), int(n.max()) + 1), -1)
        table[row, column] = two[there]
        each = np.arange(len(runs))
        table[each, n - 1] = self.last[table[each, n - 1]]
        none = len(self.keys)
        rank_of = np.append(self.order, none)
        ranks = rank_of[self._find(table[:, :-1], table[:, 1:])]
        done, live = table.copy(), each
        columns = np.arange(ranks.shape[1])
        while len(live):
            at = ranks.argmin(1)
            going = ranks[np.arange(len(live)), at] < none
            done[live[~going]] = table[~going]
            live, table, ranks, at = live[going], table[going], ranks[going], at[going]
            if not len(live):
                break
            each = np.arange(len(live))
            made = self.made[self._find(table[each, at], table[each, at + 1])]
            after = columns[None, :] > at[:, None]
            table[:, :-1] = np.where(after, table[:, 1:], table[:, :-1])
            table[:, -1] = -1
            table[each, at] = made
            ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = none
            ranks[each, at] = rank_of[self._find(made, table[each, at + 1])]
            left = np.maximum(at - 1, 0)
            before = rank_of[self._find(table[each, left], made)]
            ranks[each, left] = np.where(at > 0, before, ranks[each, left])
        return done[done >= 0], (done >= 0).sum(1)


class WordCodec:
    """Ids of whole texts: the automaton for known words, exact merges for others."""

    def __init__(self, tokenizer_path: str, lexicon: dict[str, np.ndarray]):
        self.tok = _tokenizer(tokenizer_path)
        self.auto = lexicon
        self.special = _specials(self.tok)
        vocab = {n: t for t, n in self.tok.get_vocab().items()}
        self.names = pa.array([vocab.get(n, "") for n in range(max(vocab) + 1)], pa.string())
        self.merges = Merges.of(self.tok) if _parts_apart(self.tok) else None
        self.cache: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}     # parts of longer ago

    def learn(self, parts: set[str]) -> None:
        """Remember the ids of these parts of words."""
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        missing = parts.difference(self.cache)
        again = missing.intersection(self.older)
        self.cache.update((p, self.older[p]) for p in again)
        new = list(missing.difference(again))
        for p, e in zip(new, self.tok.encode_batch(new, add_special_tokens=False), strict=True):
            self.cache[p] = e.ids

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that the automaton lacks, and how many each word has: the
        letters in front by vectorised merges, the rest by the tokenizer."""
        shape = _SHAPE.fullmatch if self.merges else (lambda w: None)
        split = [m.groups() if (m := shape(w)) else ("", w) for w in words]
        none = np.zeros(len(words), np.int64)
        flat, start, size = (self.merges.merge([s[0] for s in split]) if self.merges
                             else (none[:0], none, none))
        rest = [s[1] for s in split]
        self.learn(set(rest))
        ids = list(map(self.cache.__getitem__, rest))
        rest_size = np.fromiter(map(len, ids), np.int64, len(ids))
        start = np.stack([start, len(flat) + np.cumsum(rest_size) - rest_size], 1).ravel()
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(ids), np.int64)])
        return _ragged(flat, start, np.stack([size, rest_size], 1).ravel()), size + rest_size

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Ends and ids of texts, and what each decodes to; the texts hold neither
        special tokens nor the separators 1C to 1F."""
        ends, words = words_of(texts)
        distinct, at = words.dictionary, words.indices.to_numpy()
        numbers = traverse(self.auto, distinct.cast(pa.binary()).to_pylist())
        hit = numbers >= 0
        flat, sizes = self.merged(distinct.filter(pa.array(~hit)).to_pylist())
        id_start, ids = self.auto["id_start"], self.auto["ids"]
        start, size = np.zeros(len(hit), np.int64), np.zeros(len(hit), np.int64)
        start[hit] = id_start[numbers[hit]]
        size[hit] = id_start[numbers[hit] + 1] - start[hit]
        start[~hit], size[~hit] = len(ids) + np.cumsum(sizes) - sizes, sizes
        flat = np.concatenate([ids, flat]).astype(np.int32)
        # words without ids leave no trace in what is decoded
        kept = size[at] > 0
        ends, at = np.concatenate([[0], np.cumsum(kept)])[ends], at[kept]
        marks = np.concatenate([[0], np.cumsum(size[at])])
        coded = _ragged(flat, start[at], size[at])
        if self.tok.decoder is not None:
            plain = pa.array([self.decode(coded[a:z]) for a, z in
                              zip(marks[ends[:-1]], marks[ends[1:]], strict=True)], pa.string())
        else:
            each = _joined(np.concatenate([[0], np.cumsum(size)]),
                           self.names.take(pa.array(_ragged(flat, start, size))))
            plain = _joined(ends, each.take(pa.array(at)))
        return marks[ends], coded, plain

    def code_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The same for texts that only the tokenizer itself can part."""
        ids = [self.tok.encode(t, add_special_tokens=False).ids for t in texts]
        return (np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64),
                np.fromiter(chain.from_iterable(ids), np.int32),
                pa.array([self.decode(i) for i in ids], pa.string()))

    def whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts only the tokenizer itself can part."""
        found = pc.match_substring_regex(texts, _PY_ONLY)
        for s in self.special:
            found = pc.or_(found, pc.match_substring(texts, s))
        return found.to_numpy(zero_copy_only=False)

    def decode(self, ids) -> str:
        """As the tokenizer: a vocabulary without a decoder joins tokens by spaces."""
        if self.tok.decoder is not None:
            return self.tok.decode(list(map(int, ids)), skip_special_tokens=False)
        return " ".join(self.names[i].as_py() for i in ids)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """One row per input row: doc_id, ids, decoded.

    Null is the empty text, which has no ids and decodes to the empty text. A
    null id is kept, repeated rows give repeated rows, an empty table gives none,
    other columns are ignored."""
    small_arrow_batches(docs.sparkSession, BATCH_ROWS)
    name = build_lexicon(docs, tokenizer_path, text_col, lexicon_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = per_worker("codec " + name, lambda: WordCodec(
            tokenizer_path, load_lexicon(SparkFiles.get(name))))
        for b in batches:
            whole = codec.whole(_texts(b.column(1)))
            for alone in (False, True):
                rows = b.filter(pa.array(whole == alone))
                if not len(rows):
                    continue
                texts = _texts(rows.column(1))
                ends, ids, plain = codec.code_whole(texts.to_pylist()) if alone else codec.code(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(0), lists, plain],
                                                 names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
