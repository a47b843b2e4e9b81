"""Token ids in word-aligned binary files: Simple-8b with escapes and per-block offsets.

A 64-bit word holds a selector in its top 4 bits and, below, as many equally wide values as the selector says. A value
is the id plus one; 0 stands for an id that would need more than ``ESCAPE_BITS`` bits and is kept in a list of escapes.
Words never cross a block of ``BLOCK`` ids, and each segment lists where every block's words and escapes begin, so any
block can be read alone and all blocks decode together by one gather per selector.

A segment is one binary value: the header, block offsets, document ids and lengths, words, escapes (little-endian).
Segments lie, in ascending id order, in the rows of a Parquet folder, so that the files live in any store that Spark
writes to; ``part`` and ``seq`` order them and ``start`` counts the ids of the part before them.

Defined cases: a null or empty text has no ids but the end id; documents without an id come first; equal ids are
ordered by text; an empty table makes files without segments.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_transducer import ENDINGS, NUMBER, SPACE, kinds
from .common import plain, slices

# Fixed values of the format: how many values of how many bits a word holds, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = 0x5338_4231
BLOCK = 1024
ESCAPE_BITS = 15
SLICE = 8_000_000  # characters whose distinct words are encoded together
CACHE_WORDS = 300_000  # words a worker remembers
SEGMENT_IDS = 1 << 18  # ids after which a segment is closed; a document is never cut

SEGMENT = "part int, seq int, start long, n_docs int, n_ids long, payload binary"


_BITS = np.zeros(1 << ESCAPE_BITS, np.uint8)
for _w in range(ESCAPE_BITS):
    _BITS[1 << _w :] = _w + 1


def selectors(values: np.ndarray) -> np.ndarray:
    """The selector that holds most of the values from each place on; beyond a block's end a word is filled up with 0."""
    n = len(values)
    rows = -(-n // BLOCK)
    bits = np.zeros((rows, BLOCK + int(COUNTS[0])), np.uint8)
    bits[:, :BLOCK].flat[:n] = _BITS[values]
    choice = np.full((rows, BLOCK), len(COUNTS) - 1, np.int8)
    most, by_count = bits[:, :BLOCK].copy(), {int(c): k for k, c in enumerate(COUNTS)}
    for count in range(2, int(COUNTS[0]) + 1):
        np.maximum(most, bits[:, count - 1 : count - 1 + BLOCK], out=most)
        if (k := by_count.get(count)) is not None:
            fits = most <= WIDTHS[k]
            if not fits.any() and WIDTHS[k] <= WIDTHS[4]:
                break  # no place has so many small values, nor more of smaller ones
            choice[fits] = k
    return choice.ravel()[:n]


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, escapes, and per block where its words and its escapes begin."""
    n = len(ids)
    escaped = ids >= (1 << ESCAPE_BITS) - 1
    values = np.where(escaped, 0, ids.astype(np.int64) + 1)
    choice = selectors(values)
    block_end = np.minimum((np.arange(n) // BLOCK + 1) * BLOCK, n)
    jump = np.minimum(np.arange(n) + COUNTS[choice], block_end)
    begins = np.zeros(n, bool)
    at = np.arange(0, n, BLOCK)
    while len(at):  # all blocks take their next word together
        begins[at] = True
        following = jump[at]
        at = following[following < block_end[at]]
    first = np.flatnonzero(begins)
    selector = choice[first]
    words = selector.astype(np.uint64) << np.uint64(60)
    padded = np.r_[values.astype(np.uint64), np.zeros(int(COUNTS[0]), np.uint64)]
    for k in np.unique(selector):
        if not WIDTHS[k]:
            continue
        rows = np.flatnonzero(selector == k)
        at, end, held = first[rows], block_end[first[rows]], np.zeros(len(rows), np.uint64)
        for j in range(int(COUNTS[k])):
            held |= np.where(at + j < end, padded[at + j], np.uint64(0)) << np.uint64(j * int(WIDTHS[k]))
        words[rows] |= held
    blocks = np.arange(0, n, BLOCK)
    return words, ids[escaped].astype(np.uint32), np.searchsorted(first, blocks), np.r_[0, np.cumsum(escaped)][blocks]


def unpack(words: np.ndarray, escapes: np.ndarray, word_offsets: np.ndarray, n: int) -> np.ndarray:
    """All ids of a segment, every selector's words at once."""
    if not n:
        return np.zeros(0, np.uint32)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    # Each block is known to hold BLOCK ids (the last one the rest), so its last word may be filled only in part.
    base = np.arange(len(word_offsets)) * BLOCK
    block = np.repeat(np.arange(len(word_offsets)), np.diff(np.r_[word_offsets, len(words)]))
    raw = np.cumsum(counts) - counts
    first = raw - raw[word_offsets][block] + base[block]
    stop = np.minimum(first + counts, np.minimum(base + BLOCK, n)[block])
    out = np.zeros(n + 240, np.uint64)
    for k in np.unique(selector):
        width, count = WIDTHS[k], COUNTS[k]
        if not width:
            continue
        rows = np.flatnonzero(selector == k)
        shifts = (np.arange(count) * width).astype(np.uint64)
        held = (words[rows, None] >> shifts) & np.uint64((1 << int(width)) - 1)
        places = first[rows, None] + np.arange(count)
        inside = places < stop[rows, None]
        out[places[inside]] = held[inside]
    out = out[:n]
    ids = (out - np.uint64(1)).astype(np.uint32)
    ids[out == 0] = escapes
    return ids


def segment(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    words, escapes, word_offsets, escape_offsets = pack(ids)
    known = np.array([d is not None and d == d for d in doc_ids], np.uint8)  # noqa: PLR0124  NaN is a missing id
    numbers = np.array([int(d) if k else 0 for d, k in zip(doc_ids, known, strict=True)], "<i8")
    head = np.array([MAGIC, len(doc_ids), len(ids), len(words), len(escapes), len(word_offsets)], "<u8")
    parts = (head, word_offsets.astype("<u8"), escape_offsets.astype("<u8"), numbers, np.array(lengths, "<u8"), words.astype("<u8"), escapes.astype("<u4"), known)
    return b"".join(p.tobytes() for p in parts)


class Segment:
    """A segment read back; ``block(i)`` decodes one block alone."""

    def __init__(self, payload: bytes):
        magic, docs, self.n, words, escapes, blocks = np.frombuffer(payload, "<u8", 6).tolist()
        if magic != MAGIC:
            raise ValueError("not a segment of packed ids")
        at = 48

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.word_offsets, self.escape_offsets = take("<u8", blocks).astype(np.int64), take("<u8", blocks).astype(np.int64)
        numbers, self.lengths = take("<i8", docs), take("<u8", docs).astype(np.int64)
        self.words, self.escapes, known = take("<u8", words), take("<u4", escapes), take("u1", docs)
        self.doc_ids = [d if k else None for d, k in zip(numbers.tolist(), known.tolist(), strict=True)]

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.escapes, self.word_offsets, self.n)

    def block(self, i: int) -> np.ndarray:
        w, e = np.r_[self.word_offsets, len(self.words)], np.r_[self.escape_offsets, len(self.escapes)]
        return unpack(self.words[w[i] : w[i + 1]], self.escapes[e[i] : e[i + 1]], np.zeros(1, np.int64), min(BLOCK, self.n - i * BLOCK))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def _latin() -> tuple[np.ndarray, bytes]:
    """Of the first 256 characters: their kinds, and each in lower case."""
    return kinds()[:256], bytes(ord(chr(b).lower()) for b in range(256))


def cut_latin(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The vocabulary's words of texts in single-byte characters, lower-cased, and how many each text has.

    Runs of letters, single numbers, runs of other signs; an apostrophe with a word ending is a word; white space
    is dropped.
    """
    kind_of, lower = _latin()
    raw = np.frombuffer(b"".join(texts).translate(lower), np.uint8)
    n, ends = len(raw), np.cumsum([len(t) for t in texts], dtype=np.int64)
    kind = kind_of[raw]
    first = np.ones(n + 3, bool)  # of a text; what lies beyond the end counts as one
    first[:n] = False
    first[ends[:-1]] = True
    change = first[:n].copy()
    change[:1] = True
    change[1:] |= kind[1:] != kind[:-1]
    start = change | (kind == NUMBER)
    quotes = np.flatnonzero((raw == 39) & change)
    padded = np.r_[raw, np.zeros(3, np.uint8)]
    for ending in ENDINGS:
        hit = np.ones(len(quotes), bool)
        for i, c in enumerate(ending, 1):
            hit &= (padded[quotes + i] == ord(c)) & ~first[quotes + i]
        at = quotes[hit]
        for i in range(1, len(ending) + 1):
            start[at + i] = False
        after = at + len(ending) + 1
        start[after[after < n]] = True
    starts = np.flatnonzero(start)
    offsets = np.r_[starts, n].astype(np.int32)
    kept = kind[starts] != SPACE
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    before = np.r_[0, np.cumsum(kept)]
    at_text = before[np.searchsorted(starts, np.r_[0, ends])]
    return words.filter(pa.array(kept)), np.diff(at_text)


class Encoder:
    """Ids of texts by the tokenizers library, which sees each distinct word of simple texts once."""

    def __init__(self, path: str):
        self.library = _tokenizer(path)
        words = self.library.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)  # ids that end a word
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.known: dict[bytes, list[int]] = {}

    def ids_of(self, words: list[bytes]) -> list[list[int]]:
        """Many words in one library call: a word's last id says that it ends there."""
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known.clear()
            fresh = words
        parts = [fresh[i : i + 512] for i in range(0, len(fresh), 512)]
        coded = self.library.encode_batch_fast([b" ".join(p).decode("latin-1") for p in parts], add_special_tokens=False)
        for part, e in zip(parts, coded, strict=True):
            ids = e.ids
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) == len(part):
                self.known.update(zip(part, (ids[a:b] for a, b in zip([0, *stops], stops)), strict=True))  # noqa: B905
            else:
                self.known.update((w, self.library.encode(w.decode("latin-1"), add_special_tokens=False).ids) for w in part)
        return [self.known[w] for w in words]

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts, the end id after each, and how many each has.

        Texts of single-byte characters without special tokens are cut into words here; others go to the library
        whole.
        """
        simple, other = [], {}
        for i, t in enumerate(texts):
            try:
                raw = t.encode("latin-1")
            except UnicodeEncodeError:
                raw = None
            if raw is None or b"<|" in raw:
                other[i] = t
            else:
                simple.append(raw)
        words, per_text = cut_latin(simple)
        coded = words.dictionary_encode()
        ids = self.ids_of(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy().astype(np.int64)
        if other:
            whole = self.library.encode_batch_fast(list(other.values()), add_special_tokens=False)
            spread = np.ones(len(texts), np.int64)
            spread[[i for i in range(len(texts)) if i not in other]] = per_text
            at = np.cumsum(spread) - spread
            codes = np.insert(codes, (at - np.cumsum([i in other for i in range(len(texts))]) + 1)[list(other)], len(ids) + np.arange(len(other)))
            ids, per_text = ids + [e.ids for e in whole], spread
        ids.append([end_id])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        table = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        codes = np.insert(codes, np.cumsum(per_text), len(ids) - 1)
        many = sizes[codes]
        ends = np.r_[0, np.cumsum(many)]
        flat = table[np.repeat(begin[codes] - ends[:-1], many) + np.arange(ends[-1])]
        return flat, np.diff(ends[np.r_[0, np.cumsum(per_text + 1)]]).tolist()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _writer(path: str, end_id: int):
    def write(batches):
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        docs, lengths, ids, held = [], [], [], 0
        for pdf in batches:
            texts, keys = pdf["body"].tolist(), pdf["key"].tolist()
            for a, b in slices(texts, SLICE):
                flat, many = _encoder(path).encode(texts[a:b], end_id)
                docs += keys[a:b]
                lengths += many
                ids.append(flat)
                held += len(flat)
                if held >= SEGMENT_IDS:
                    yield pd.DataFrame([(part, seq, start, len(docs), held, segment(docs, lengths, np.concatenate(ids)))], columns=COLUMNS)
                    seq, start = seq + 1, start + held
                    docs, lengths, ids, held = [], [], [], 0
        if docs:
            yield pd.DataFrame([(part, seq, start, len(docs), held, segment(docs, lengths, np.concatenate(ids)))], columns=COLUMNS)

    return write


COLUMNS = [c.split()[0] for c in SEGMENT.split(", ")]


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1, doc_id="doc_id", text="text") -> None:
    """Write the ids of all texts in ascending id order; the texts are dealt out by range once and never again."""
    body = plain(docs, doc_id, text).withColumn("tie", F.xxhash64("body"))
    ranged = body.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "body").select("key", "body")
    ranged.mapInPandas(_writer(vocabulary, end_id), SEGMENT).write.parquet(folder)


def _reader(batches):
    for pdf in batches:
        for part, start, payload in zip(pdf["part"], pdf["start"], pdf["payload"], strict=True):
            s = Segment(payload)
            ids = s.ids()
            ends = np.cumsum(s.lengths)
            firsts = (ends - s.lengths).tolist()
            yield pd.DataFrame({
                "part": part, "key": pd.array(s.doc_ids, dtype="Int64"), "local": [start + f for f in firsts],
                "ids": [ids[a:b].view(np.int32) for a, b in zip(firsts, ends.tolist(), strict=True)],
            })


def _digests(batches):
    for pdf in _reader(batches):
        ids = pdf.pop("ids")
        yield pdf.assign(n_tokens=[len(x) for x in ids], ids_crc32=[zlib.crc32(x.astype("<u4").tobytes()) for x in ids])


def read(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it) and its ``ids``, or, with ``digests``,
    their number and crc32.

    Only the parts' totals, one row for each written partition, are summed up ahead and broadcast.
    """
    segments = spark.read.schema(SEGMENT).parquet(folder)
    totals = segments.groupBy("part").agg(F.max(F.col("start") + F.col("n_ids")).alias("held"))
    before = F.expr("sum(held) over (order by part rows between unbounded preceding and 1 preceding)")
    base = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    if digests:
        found = segments.mapInPandas(_digests, "part int, key long, local long, n_tokens long, ids_crc32 long")
    else:
        found = segments.mapInPandas(_reader, "part int, key long, local long, ids array<int>")
    rest = [c for c in found.columns if c not in ("part", "key", "local")]
    return found.join(F.broadcast(base), "part").select(F.col("key").alias("doc_id"), (F.col("local") + F.col("base")).alias("start"), *rest)
