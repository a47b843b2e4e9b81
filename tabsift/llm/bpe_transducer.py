"""Byte-level BPE through a minimal acyclic transducer of frequent words.

The commonest words of the corpus are compiled into a minimal acyclic automaton whose transitions carry numbers: their
sum along a path is the word's number, and a table gives the ids of each number. The automaton is one file in the
shared folder that Spark hands to every executor and each worker maps into memory; all distinct words of a batch walk
it together, one byte per step. Words it does not know are merged exactly, many at a time, by the vocabulary's ranks.
Ids equal those of the tokenizers library for the same vocabulary file; decoding goes from the ids alone.

Defined cases: null and empty texts have no ids and decode to ''; repeated rows each get their result; an empty table
gives an empty result; words longer than ``LONG_WORD`` bytes are merged one by one, whatever their length.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import commonest, plain, put_shared, slices, stage

# Fixed values of the public byte-level scheme: a text is cut into word endings after an apostrophe, then runs of
# letters, of numbers and of other signs, each with a space before it if there is one, then white space.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
OTHER, LETTER, NUMBER, SPACE = range(4)

LEXICON_WORDS = 131_072  # the automaton's size is bounded by this times LONG_WORD
LONG_WORD = 48
SLICE = 3_000_000  # characters whose words are looked up together


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merge ranks and decoding of a byte-level BPE file, with ranks in an open-addressing table for numpy."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.size = max(vocab.values()) + 1 + len(spec["added_tokens"])
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for i, token in enumerate(self.bytes):
            if len(token) == 1:
                self.of_byte[token[0]] = i
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            self.rank[vocab[a], vocab[b]] = (r, vocab[a + b])
        pairs = np.array([a * self.size + b for a, b in self.rank], np.int64)
        ranked = np.array(list(self.rank.values()), np.int64)
        self.table = Table(pairs, ranked[:, 0])
        self.merged = ranked[np.argsort(ranked[:, 0]), 1]

    def merge_word(self, word: bytes) -> list[int]:
        """One word of any length, by a heap of neighbouring pairs: n log n in its length."""
        ids = [int(self.of_byte[b]) for b in word]
        left, right = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap = [(self.rank[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]  # noqa: B905
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i] if ids[i] is not None else len(ids)
            if j >= len(ids) or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = self.rank[pair][1], None
            right[i] = right[j]
            if right[i] < len(ids):
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < len(ids) and (p := (ids[a], ids[b])) in self.rank:
                    heapq.heappush(heap, (self.rank[p][0], a, p))
        return [i for i in ids if i is not None]

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words one after another, and how many each has: each round merges the leftmost pair of lowest
        rank in every word that has one. Words beyond LONG_WORD, which would need many rounds, go one by one."""
        if any(len(w) > LONG_WORD for w in words):
            long = {i: self.merge_word(w) for i, w in enumerate(words) if len(w) > LONG_WORD}
            flat, sizes = self.merge_words([b"" if i in long else w for i, w in enumerate(words)])
            at = np.cumsum(sizes)[list(long)]
            sizes[list(long)] = [len(x) for x in long.values()]
            return np.insert(flat, np.repeat(at, [len(x) for x in long.values()]), [i for x in long.values() for i in x]), sizes
        sizes = np.array([len(w) for w in words], np.int64)
        ids = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        never = np.iinfo(np.int64).max
        while len(ids):
            ranks = np.full(len(ids), never)
            inside = np.flatnonzero(owner[:-1] == owner[1:])
            found = self.table.get(ids[inside] * self.size + ids[inside + 1])
            ranks[inside] = np.where(found < 0, never, found)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(ranks, starts)
            spread = np.repeat(best, np.diff(np.r_[starts, len(ids)]))
            still = spread != never
            done.append((owner[~still], ids[~still]))
            hits = np.flatnonzero(still & (ranks == spread))
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]] if len(hits) else hits
            ids[hits] = self.merged[ranks[hits]]
            still[hits + 1] = False
            ids, owner = ids[still], owner[still]
        owner, ids = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (sizes[:0], sizes[:0])
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))


class Table:
    """Integers to integers by open addressing, looked up for whole arrays; -1 where absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.drop, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        left, at, self.tries = np.arange(len(keys)), self.slot(keys), 0
        while len(left):
            self.tries += 1
            free = np.flatnonzero(self.keys[at] == -1)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.values[at[put]] = keys[left[put]], values[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.drop).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], -1)
        left = np.flatnonzero((seen != keys) & (seen != -1))
        for _ in range(self.tries):
            if not len(left):
                break
            at[left] = (at[left] + 1) & self.mask
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (seen != -1)]
        return out


def automaton(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words: transition keys (state * 256 + byte), targets, the number
    each transition adds, and which states accept. Equal suffixes share states, as words come in order."""
    register: dict[tuple, int] = {}
    edges: list[tuple] = []  # of a finished state: (accepts, ((byte, state), ...))
    counts: list[int] = []  # words below a finished state

    def finish(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if (state := register.get(key)) is None:
            state = register[key] = len(edges)
            edges.append(key)
            counts.append(node[0] + sum(counts[s] for _, s in node[1]))
        return state

    path: list[list] = [[0, []]]  # the nodes of the last word, not yet finished
    last = b""
    for w in words:
        shared = 0
        while shared < min(len(w), len(last)) and w[shared] == last[shared]:
            shared += 1
        for depth in range(len(last), shared, -1):
            node = path.pop()
            path[-1][1].append((last[depth - 1], finish(node)))
        path.extend([0, []] for _ in w[shared:])
        path[-1][0] = 1
        last = w
    for depth in range(len(last), 0, -1):
        node = path.pop()
        path[-1][1].append((last[depth - 1], finish(node)))
    root = finish(path[0])
    keys, targets, adds = [], [], []
    for state, (accepts, out) in enumerate(edges):
        below = accepts
        for byte, to in out:
            keys.append(state * 256 + byte)
            targets.append(to)
            adds.append(below)
            below += counts[to]
    accepting = np.array([a for a, _ in edges] + [root], np.int64)  # the last entry is the start state
    return np.array(keys, np.int64), np.array(targets, np.int64), np.array(adds, np.int64), accepting


class Lexicon:
    """The automaton and the ids of its words, over arrays that are views of one file."""

    def __init__(self, arrays: list[np.ndarray]):
        self.keys, self.values, self.targets, self.adds, self.accepting, self.offsets, self.ids, more = arrays
        self.table = Table.__new__(Table)
        self.table.keys, self.table.values, self.table.tries = self.keys, self.values, int(more[0])
        self.table.drop, self.table.mask = np.uint64(64 - (len(self.keys).bit_length() - 1)), len(self.keys) - 1

    @staticmethod
    def compile(words: list[bytes], vocabulary: Vocabulary) -> bytes:
        words = sorted(set(words))
        flat, sizes = vocabulary.merge_words(words)
        keys, targets, adds, accepting = automaton(words)
        t = Table(keys, np.arange(len(keys)))
        offsets = np.r_[0, np.cumsum(sizes)]
        arrays = [t.keys, t.values, targets, adds, accepting, offsets, flat, np.array([t.tries])]
        head = np.array([len(arrays), *map(len, arrays)], "<i8")
        return b"".join(a.astype("<i8").tobytes() for a in (head, *arrays))

    @staticmethod
    def open(path: str) -> Lexicon:
        whole = np.asarray(np.memmap(path, "<i8", "r"))  # a plain view, still of the mapped file
        sizes = whole[1 : 1 + int(whole[0])]
        cuts = np.cumsum([1 + len(sizes), *sizes])
        return Lexicon([whole[a:b] for a, b in zip(cuts, cuts[1:])])  # noqa: B905

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where the automaton has no path; all words take each step together."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        state, number = np.full(len(words), self.accepting[-1]), np.zeros(len(words), np.int64)
        alive, depth = np.flatnonzero(sizes > 0), 0
        number[sizes == 0] = -1
        while len(alive):
            edge = self.table.get(state[alive] * 256 + flat[begin[alive] + depth])
            number[alive[edge < 0]] = -1
            alive, edge = alive[edge >= 0], edge[edge >= 0]
            state[alive] = self.targets[edge]
            number[alive] += self.adds[edge]
            depth += 1
            ended = sizes[alive] == depth
            over = alive[ended]
            number[over[self.accepting[state[over]] == 0]] = -1
            alive = alive[~ended]
        return number


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of every code point."""
    out = np.zeros(0x110000, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every, at = "".join(map(chr, points)), np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[at[m.start() : m.end()]] = kind
    return out


def cut(pieces: list[str], whole: list[int] = ()) -> tuple[pa.Array, np.ndarray]:
    """The words of all pieces as one Arrow array over their bytes, and how many each piece has.

    Pieces listed in ``whole`` stay one word. Works on all code points at once.
    """
    text = "".join(pieces)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n, ends = len(codes), np.cumsum([len(p) for p in pieces], dtype=np.int64)
    begins = ends - [len(p) for p in pieces]
    kind = kinds()[codes]
    first = np.zeros(n + 3, bool)  # of a piece; what lies beyond the end counts as one
    first[begins] = True
    first[n:] = True
    change = first[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    start = change.copy()
    # White space before a word gives up its last character: a space joins the word, any other stands alone.
    last = np.zeros(n, bool)
    last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n]
    start |= last
    start[np.flatnonzero(last & (codes == 32)) + 1] = False
    quotes = np.flatnonzero((codes == 39) & change & start)
    padded = np.r_[codes, np.zeros(3, np.uint32)]
    for ending in ENDINGS:
        hit = np.ones(len(quotes), bool)
        for i, c in enumerate(ending, 1):
            hit &= (padded[quotes + i] == ord(c)) & ~first[quotes + i]
        at = quotes[hit]
        for i in range(1, len(ending) + 1):
            start[at + i] = False
        after = at + len(ending) + 1
        start[after[after < n]] = True
    for i in whole:
        start[begins[i] : ends[i]] = False
        start[begins[i]] = True
    starts = np.flatnonzero(start)
    width = 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int8) + (codes >= 0x10000)
    at_byte = np.r_[0, np.cumsum(width, dtype=np.int64)]
    offsets = np.r_[at_byte[starts], at_byte[-1]].astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text.encode())])
    return words, np.searchsorted(starts, ends) - np.searchsorted(starts, begins)


class Coder:
    """Encodes and decodes with a vocabulary and the lexicon of frequent words."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.parts = regex.compile("(" + "|".join(map(regex.escape, vocabulary.added)) + ")") if vocabulary.added else None

    def ids_of(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has."""
        raw, added = [w.encode() for w in distinct], self.vocabulary.added
        numbers = self.lexicon.numbers(raw)
        unseen = np.flatnonzero(numbers < 0)
        merged, many = self.vocabulary.merge_words([raw[i] for i in unseen.tolist()])
        offsets = self.lexicon.offsets
        sizes = np.where(numbers < 0, 0, offsets[numbers + 1] - offsets[numbers])
        sizes[unseen] = many
        # Ids of the lexicon's words are copied by position, the merged ones fill the places between.
        known = np.repeat(numbers >= 0, sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        flat = np.empty(len(known), np.int32)
        flat[known] = self.lexicon.ids[(np.repeat(offsets[numbers], sizes) + np.arange(len(known)) - first)[known]]
        flat[~known] = merged
        for i in [i for i, w in enumerate(distinct) if w in added]:
            begin = int(sizes[:i].sum())
            flat = np.r_[flat[:begin], np.int32(added[distinct[i]]), flat[begin + int(sizes[i]) :]]
            sizes[i] = 1
        return flat, sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as the vocabulary's library gives them."""
        added = self.vocabulary.added
        marked = [any(t in text for t in added) for text in texts]
        split = [self.parts.split(t) if m else [t] for t, m in zip(texts, marked, strict=True)]
        pieces = [p for ps in split for p in ps]
        words, per_piece = cut(pieces, [i for i, p in enumerate(pieces) if p in added])
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy()
        flat, sizes = self.ids_of(coded.dictionary.to_pylist())
        begin = np.cumsum(sizes) - sizes
        of_word = sizes[codes]
        ends = np.r_[0, np.cumsum(of_word)]
        ids = flat[np.repeat(begin[codes] - ends[:-1], of_word) + np.arange(ends[-1])]
        at_piece = np.r_[0, np.cumsum(per_piece)]
        cuts = ends[at_piece[np.r_[0, np.cumsum([len(ps) for ps in split])]]].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]  # noqa: B905

    def decode(self, ids: list[int]) -> str:
        table = self.vocabulary.bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def _coder(path: str, lexicon: str) -> Coder:
    return Coder(_vocabulary(path), Lexicon.open(SparkFiles.get(lexicon)))


def _count(batches):
    for batch in batches:
        texts = batch.column("body").to_pylist()
        for a, b in slices(texts, SLICE):
            values, counts = cut(texts[a:b])[0].value_counts().flatten()
            yield pa.RecordBatch.from_arrays([values, counts], ["word", "n"])


def word_counts(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """How often each word occurs in all texts: (word, n)."""
    counted = plain(docs, doc_id, text).select("body").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, vocabulary: str, doc_id="doc_id", text="text", words: int = LEXICON_WORDS) -> str:
    """Compile the corpus's commonest words and hand the file to all executors; returns its name there."""
    spark = docs.sparkSession
    short = word_counts(docs, doc_id, text).filter(F.octet_length("word").between(1, LONG_WORD))
    common = [w.encode() for w, _ in commonest(stage(short, "word-counts"), "word", "n", words)]
    uri = put_shared(spark, "lexicon", Lexicon.compile(common, _vocabulary(vocabulary)))
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


def _encoder(vocabulary: str, name: str, finish):
    def encode(batches):
        coder = _coder(vocabulary, name)
        for pdf in batches:
            texts = pdf["body"].tolist()
            for a, b in slices(texts, SLICE):
                ids = coder.encode(texts[a:b])
                yield finish(pdf.drop(columns="body").iloc[a:b], ids, coder)

    return encode


def _with_ids(part: pd.DataFrame, ids: list[np.ndarray], coder: Coder) -> pd.DataFrame:
    lists = [x.tolist() for x in ids]
    return part.assign(ids=ids, decoded=[coder.decode(x) for x in lists])


def encode(docs: DataFrame, vocabulary: str, doc_id="doc_id", text="text", words: int = LEXICON_WORDS) -> DataFrame:
    """Per document its id, ``ids`` and the text ``decoded`` from them."""
    body = plain(docs, doc_id, text)
    schema = f"key {body.schema['key'].dataType.simpleString()}, ids array<int>, decoded string"
    name = lexicon(docs, vocabulary, doc_id, text, words)
    return body.mapInPandas(_encoder(vocabulary, name, _with_ids), schema).withColumnRenamed("key", doc_id)
