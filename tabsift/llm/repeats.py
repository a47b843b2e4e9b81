"""Repeated byte strings, found by merging Burrows-Wheeler transforms of shards.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts earlier: in a document before, or before in
the same one. Strings never cross documents and are judged on the input.

Finding where to look. Every string of LENGTH bytes has an anchor, its ``GRAM``-byte gram of least hash; neighbouring
strings mostly share it, which cuts a document into segments of one anchor each, and equal strings have equal anchors.
Anchors that occur once are done with. A segment whose content occurred before is a repeat as a whole. What is left,
per anchor the first occurrences of two or more different contents, may still share some of their strings.

Merging. Contents of an anchor meet in one task, which cuts them into shards, sorts the rotations within each shard
and keeps its transform. The shards' transforms are then interleaved: from the order by the first bytes, each round
stably sorts the interleave by the two symbols before every suffix, which makes it right to two bytes more. Where
neighbours differ in a round is where common prefixes end, so after LENGTH bytes the blocks left are the repeated
intervals; no suffix is sorted again. All but the earliest string of a block are repeats.

An anchor with more than ``HOT`` contents would be one large task; its strings are told apart by 128-bit digests in a
grouping that combines before the shuffle. Contents are told apart by 64 digest bits and those of their anchor.

Defined cases: null and empty texts, and those shorter than LENGTH, lose nothing; documents without an id come before
all others; ids that are not whole numbers count in their own order; of different texts with one id the one with the
smaller digest comes first, and equal rows are one document, with the same result for each; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import plain, slices, stage
from .merkle import placed

LENGTH = 100
GRAM = 32
HOT = 4096
CHUNK = 128 * 1024  # bytes of documents worked on together
MERGE = 1 << 20  # bytes of contents merged together, and of each shard
SHARD = 1 << 18
PLACE_BITS = 24  # of a gram's place among bytes worked on together, below the bits of its hash
PIECE = 1 << 20  # strings of a document worked on together; far fewer than places
SEED = 8  # bytes by which the first interleave is ordered
PARTS = 4  # ranges of the anchor's place by which contents are compared before merging

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * _M1 + b
    return (x ^ (x >> np.uint64(32))) * _M2


def segments(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of documents laid end to end: per segment the anchor's hash, the content's digest, the document, the first
    string's place in it, how many strings there are and how far the anchor lies behind the first place."""
    n, width = len(raw), LENGTH - GRAM + 1
    if n > 1 << PLACE_BITS:
        raise ValueError(f"{n} bytes at once, but places have {PLACE_BITS} bits")
    empty = np.zeros(0, np.int64)
    if n < LENGTH:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty, empty
    padded = np.r_[raw, np.zeros(8, np.uint8)]
    eight = as_strided(padded.view(np.uint8), (n, 8), (1, 1)).copy().view("<u8").ravel()
    sixteen = _mix(eight[:-8], eight[8:])
    gram = _mix(sixteen[: n - GRAM + 1], sixteen[16 : n - GRAM + 17])
    at_bits = np.uint64((1 << PLACE_BITS) - 1)
    least = (gram & ~at_bits) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while span < width:  # the least, then leftmost, gram of each string, by doubling
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    anchor = (least & at_bits).astype(np.int64)
    whole = np.zeros(len(anchor), bool)  # strings that lie in one document
    owner = np.repeat(np.arange(len(begins)), ends - begins)
    whole[:] = owner[: len(anchor)] == owner[LENGTH - 1 : LENGTH - 1 + len(anchor)]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1 : len(anchor)] != owner[: len(anchor) - 1])]
    starts = np.flatnonzero(new & whole)
    stops = np.r_[np.flatnonzero(new | ~whole), len(anchor)]
    counts = stops[np.searchsorted(stops, starts, side="right")] - starts
    last = starts + counts - 1

    def string(at: np.ndarray) -> np.ndarray:
        h = _mix(gram[at], gram[at + GRAM])
        return _mix(_mix(h, gram[at + 2 * GRAM]), gram[at + LENGTH - GRAM])

    digest = _mix(_mix(string(starts), string(last)), counts.astype(np.uint64))
    doc = owner[starts]
    return gram[anchor[starts]], digest, doc, starts - begins[doc], counts, anchor[starts] - starts


def pieces(begins: np.ndarray, ends: np.ndarray, piece: int = PIECE):
    """(first document, one past the last, first byte, one past the last) of what is worked on together.

    Whole documents up to CHUNK bytes, or a single one; parts of a document with over ``piece`` strings overlap by the
    LENGTH - 1 bytes that let every string lie in exactly one.
    """
    first = 0
    while first < len(ends):
        from_ = int(begins[first])
        last = max(first + 1, int(np.searchsorted(ends, from_ + CHUNK, side="right")))
        to = int(ends[last - 1])
        step = piece if last == first + 1 else to - from_
        for at in range(from_, max(from_ + 1, to - LENGTH + 1), max(1, step)):
            yield first, last, at, min(to, at + step + LENGTH - 1)
        first = last


def _anchors(bits: int, piece: int = PIECE):
    drop = np.uint64(64 - bits)

    def run(batches):
        for batch in batches:
            key, tie, texts = (batch.column(c) for c in ("at", "tie", "body"))
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1])
            keys, ties = key.to_numpy(), tie.to_numpy()
            raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            base = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset] if len(texts) else 0
            ends = base + np.cumsum(sizes)
            for first, last, from_, to in pieces(ends - sizes, ends, piece):
                begins, stops = np.maximum(ends[first:last] - sizes[first:last], from_), np.minimum(ends[first:last], to)
                hashes, digest, doc, lo, n, off = segments(raw[from_:to], begins - from_, stops - from_)
                if len(hashes):
                    lo += (begins - (ends[first:last] - sizes[first:last]))[doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((hashes >> drop).view(np.int64)), pa.array(digest.view(np.int64)), pa.array(keys[first:last][doc]), pa.array(ties[first:last][doc]),
                         pa.array(lo.astype(np.int32)), pa.array((off * 128 + n).astype(np.int32))],
                        ["anchor", "content", "at", "tie", "lo", "shape"],
                    )

    return run


def rotations(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Order of all rotations of strings laid end to end, each with its end sign; equal ones by string."""
    n = len(codes)
    owner = np.repeat(np.arange(len(begins)), sizes)
    first, size = begins[owner], sizes[owner]
    within = np.arange(n) - first
    rank, depth = codes.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 1) + rank[first + (within + depth) % size]
        order = np.argsort(key, kind="stable")
        new = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, new[1:] != new[:-1]])
        depth *= 2
        if depth >= sizes.max() or rank.max() == n - 1:
            return np.lexsort((owner, rank)) if rank.max() < n - 1 else order


class Shard:
    """A shard's rotations in order: where each begins, the two symbols before it and the bytes it starts with."""

    def __init__(self, strings: list[bytes], first: int):
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        begins = np.cumsum(sizes) - sizes
        codes = np.zeros(int(sizes.sum()), np.uint16)
        inside = np.ones(len(codes), bool)
        inside[begins + sizes - 1] = False
        codes[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
        order = rotations(codes, begins, sizes)
        owner = np.repeat(np.arange(len(strings)), sizes)
        head, size = begins[owner], sizes[owner]
        within = np.arange(len(codes)) - head

        def turned(by: int) -> np.ndarray:
            return codes[head + (within + by) % size]

        self.string, self.offset = first + owner[order], within[order]
        self.before = (turned(-2)[order], turned(-1)[order])
        lead = np.zeros(len(codes), np.uint64)
        low = np.zeros(len(codes), np.uint64)
        for i in range(SEED):  # nine bits a symbol: seven of them in one key, the last in another
            if i < 7:
                lead = (lead << np.uint64(9)) | turned(i)
            else:
                low = (low << np.uint64(9)) | turned(i)
        self.lead, self.low = lead[order], low[order]


def interleaved(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged order by the first LENGTH bytes: per place its string, its offset and its block of equal prefixes."""
    lead, low = (np.concatenate([getattr(s, n) for s in shards]) for n in ("lead", "low"))
    of_shard = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.lead) for s in shards])
    order = np.lexsort((low, lead))  # stable: shards keep their own order
    z = of_shard[order]
    lead, low = lead[order], low[order]
    block = np.cumsum(np.r_[0, (lead[1:] != lead[:-1]) | (low[1:] != low[:-1])])
    # The symbols that occur, numbered in order, so that two of them mostly fit sixteen bits.
    a, b = (np.concatenate([s.before[i] for s in shards]) for i in (0, 1))
    used = np.zeros(257, bool)
    used[a] = used[b] = True
    number = np.cumsum(used) - 1
    pairs = number[a] * int(used.sum()) + number[b]
    pairs = pairs.astype(np.uint16 if used.sum() <= 256 else np.uint32)
    for _ in range((LENGTH - SEED) // 2):
        symbol = np.empty(len(z), pairs.dtype)
        symbol[np.argsort(z, kind="stable")] = pairs
        order = np.argsort(symbol, kind="stable")
        z, block, symbol = z[order], block[order], symbol[order]
        block = np.cumsum(np.r_[0, (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])])
    place = np.argsort(z, kind="stable")
    string, offset = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
    string[place] = np.concatenate([s.string for s in shards])
    offset[place] = np.concatenate([s.offset for s in shards])
    return string, offset, block


def later_strings(contents: list[bytes], counts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of contents, each with ``counts`` strings from its start on: rows (content, offset) of the strings that equal
    one whose document and place (``order`` of the content plus the offset) come before."""
    shards, held, first = [], [], 0
    for i, c in enumerate(contents):
        held.append(c)
        if sum(map(len, held)) >= SHARD or i == len(contents) - 1:
            shards.append(Shard(held, first))
            first, held = i + 1, []
    string, offset, block = interleaved(shards)
    ours = np.flatnonzero(offset < counts[string])
    string, offset, block = string[ours], offset[ours], block[ours]
    at = order[string] + offset
    least = np.full(int(block.max()) + 1 if len(block) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, block, at)
    late = at > least[block]
    return np.stack([string[late], offset[late]], axis=1)


def shared_ranges(keys: np.ndarray, contents: list[bytes], counts: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per content the range of strings that another content of its anchor may hold.

    Strings whose anchor lies in one range of places behind their start have the bytes around it in common; a range
    whose bytes no other content of the anchor has can't hold a repeat.
    """
    room = LENGTH - GRAM
    step = -(-(room + 1) // PARTS)
    low, high = np.full(len(contents), np.iinfo(np.int64).max), np.full(len(contents), -1)
    for a in range(0, room + 1, step):
        b = min(a + step - 1, room)
        seen: dict[tuple, int] = {}
        for i, (k, c, n, off) in enumerate(zip(keys.tolist(), contents, counts.tolist(), offs.tolist(), strict=True)):
            from_, to = max(0, off - b), min(n - 1, off - a)  # strings whose anchor is a to b bytes behind their start
            if from_ > to:
                continue
            around = (k, c[off - a : off + LENGTH - b])
            other = seen.setdefault(around, i)
            if other != i:
                for j in (i, other):
                    of, no = int(offs[j]), int(counts[j])
                    low[j], high[j] = min(low[j], max(0, of - b)), max(high[j], min(no - 1, of - a))
    return low, high


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    keys, contents = pdf["anchor"].to_numpy(), [bytes(c) for c in pdf["content"]]
    counts, offs = pdf["shape"].to_numpy() % 128, pdf["shape"].to_numpy() // 128
    low, high = shared_ranges(keys, contents, counts, offs)
    kept = np.flatnonzero(high >= 0)
    if not len(kept):
        return pdf.iloc[:0][["at", "tie"]].assign(start=np.zeros(0, np.int32), end=np.zeros(0, np.int32))
    low, high = low[kept], high[kept]
    cut = [contents[i][a : b + LENGTH] for i, a, b in zip(kept.tolist(), low.tolist(), high.tolist(), strict=True)]
    at, tie, lo = (pdf[c].to_numpy()[kept] for c in ("at", "tie", "lo"))
    docs = np.lexsort((tie, at))
    rank = np.empty(len(docs), np.int64)
    rank[docs] = np.cumsum(np.r_[0, (at[docs][1:] != at[docs][:-1]) | (tie[docs][1:] != tie[docs][:-1])])
    found = later_strings(cut, high - low + 1, (rank << 32) + lo + low)
    if not len(found):
        return pdf.iloc[:0][["at", "tie"]].assign(start=np.zeros(0, np.int32), end=np.zeros(0, np.int32))
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    new = np.r_[True, (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(found)] - 1
    who = found[first, 0]
    start = lo[who] + low[who] + found[first, 1]
    end = lo[who] + low[who] + found[last, 1] + LENGTH
    return pd.DataFrame({"at": at[who], "tie": tie[who], "start": start.astype(np.int32), "end": end.astype(np.int32)})


def _merger(batches):
    """Rows come sorted by anchor: whole anchors are gathered up to MERGE bytes and merged together."""
    held: pd.DataFrame | None = None
    for pdf in batches:
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        while held is not None and len(held):
            sizes = held["content"].map(len).to_numpy().cumsum()
            if sizes[-1] < MERGE:
                break
            keys = held["anchor"].to_numpy()
            borders = np.flatnonzero(keys[1:] != keys[:-1]) + 1  # the last anchor may go on in the next batch
            if not len(borders):
                break
            stop = int(borders[min(len(borders) - 1, int(np.searchsorted(sizes[borders - 1], MERGE)))])
            if (out := _merge(held.iloc[:stop])) is not None and len(out):
                yield out
            held = held.iloc[stop:].reset_index(drop=True)
    if held is not None and len(held) and len(out := _merge(held)):
        yield out


def _contents(batches):
    for pdf in batches:
        for a, b in slices(pdf["body"].tolist()):
            part, columns = pdf.iloc[a:b], {c: [] for c in ("anchor", "at", "tie", "lo", "shape", "hot", "content")}
            for at, tie, body, anchors, places in zip(part["at"], part["tie"], part["body"], part["anchors"], part["places"], strict=True):
                raw, places = body.encode(), np.asarray(places)
                lo, shape = places >> 32, (places & 0xFFFFFFFF) >> 1
                ends = lo + shape % 128 + LENGTH - 1
                columns["content"] += [raw[x:y] for x, y in zip(lo.tolist(), ends.tolist(), strict=True)]
                for c, values in (("anchor", anchors), ("lo", lo), ("shape", shape), ("hot", places & 1 == 1), ("at", np.full(len(lo), at)), ("tie", np.full(len(lo), tie))):
                    columns[c].append(np.asarray(values))
            yield pd.DataFrame({c: v if c == "content" else np.concatenate(v) for c, v in columns.items()})


def _strings(batches):
    for pdf in batches:
        for at, tie, lo, content in zip(pdf["at"], pdf["tie"], pdf["lo"], pdf["content"], strict=True):
            n = len(content) - LENGTH + 1
            raw = b"".join(xxhash.xxh3_128_digest(content[i : i + LENGTH]) for i in range(n))
            halves = np.frombuffer(raw, "<i8").reshape(-1, 2)
            yield pd.DataFrame({"h1": halves[:, 0], "h2": halves[:, 1], "at": at, "tie": tie, "lo": np.arange(lo, lo + n, dtype=np.int32)})


def _cut(raw: bytes, spans) -> tuple[np.ndarray, bytes]:
    """The removed runs, as rows (start, end), and the bytes that stay."""
    cover = np.zeros(len(raw) + 1, np.int32)
    spans = np.asarray(spans, np.int64)
    np.add.at(cover, spans >> 32, 1)
    np.add.at(cover, spans & 0xFFFFFFFF, -1)
    gone = np.cumsum(cover)[:-1] > 0
    return np.flatnonzero(np.diff(np.r_[False, gone, False])).reshape(-1, 2), np.frombuffer(raw, np.uint8)[~gone].tobytes()


def _remove(batches):
    for pdf in batches:
        for a, b in slices(pdf["body"].tolist()):
            part, rows = pdf.iloc[a:b], []
            for body, spans in zip(part["body"], part["spans"], strict=True):
                raw = body.encode()
                runs, kept = _cut(raw, spans if spans is not None else [])
                rows.append((len(raw), len(raw) - len(kept), [{"start": x, "end": y} for x, y in runs.tolist()], kept))
            yield pd.DataFrame({"key": part["key"].to_numpy(), **{c: [r[i] for r in rows] for i, c in enumerate(("n_bytes", "n_removed", "removed", "kept"))}})


def _identified(docs: DataFrame) -> tuple[DataFrame, bool]:
    """All rows (key, body, …) with columns that tell documents apart and order them, and whether an id occurs twice.

    Ids that are not whole numbers are numbered in their own order.
    """
    key = docs.schema["key"].dataType
    if isinstance(key, IntegralType):
        number = F.col("key").cast("long")
        found = docs
    else:
        ids = docs.select("key").where("key is not null").distinct().withColumn("tree", F.lit(0))
        found = docs.join(placed(ids, "tree", [F.col("key")]).select("key", F.col("at").alias("number")), "key", "left")
        number = F.col("number")
    found = found.withColumn("at", F.coalesce(number, F.lit(-(2**63))))
    # Only where an id occurs twice does a text's digest tell documents apart; else it would be shuffled for nothing.
    repeated_ids = found.groupBy("at").count().filter("count > 1").limit(1).count() > 0
    body = F.coalesce("body", F.lit(""))
    return found.withColumn("tie", F.xxhash64(body) if repeated_ids else F.lit(0).cast("long")), repeated_ids


def repeated_spans(docs: DataFrame, hot: int = HOT, piece: int = PIECE) -> DataFrame:
    """(at, tie, spans) of the documents that hold repeats: runs [start, end) that may overlap, as start * 2^32 + end.

    Takes (key, body) rows.
    """
    body, repeated_ids = _identified(docs)
    total = body.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    # As many bits of an anchor's hash as keep chance meetings rare; more only for more data.
    bits = min(64, max(24, math.ceil(math.log2(total + 1)) + 6))
    found = body.select("at", "tie", "body").mapInArrow(_anchors(bits, piece), "anchor long, content long, at long, tie long, lo int, shape int")
    # Written first, so that the join shuffles both sides for itself and may split an anchor that many rows have.
    often = stage(found.select("anchor").groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    again = stage(found.join(often, "anchor"), "repeated-anchors")

    place = F.struct("at", "tie", "lo", "shape")
    firsts = stage(again.groupBy("anchor", "content").agg(F.min(place).alias("first")), "contents")
    whole = again.join(firsts, ["anchor", "content"]).filter(
        ~((F.col("at") == F.col("first.at")) & (F.col("tie") == F.col("first.tie")) & (F.col("lo") == F.col("first.lo")))
    )
    spans = whole.select("at", "tie", F.col("lo").alias("start"), (F.col("lo") + F.col("shape") % 128 + (LENGTH - 1)).cast("int").alias("end"))

    many = firsts.groupBy("anchor").count().filter("count > 1")
    open_ = firsts.join(many, "anchor").select("anchor", "first.*", (F.col("count") > hot).alias("hot"))
    # Numbers in plain arrays: place, shape and heat of a content in one long.
    packed = F.shiftleft(F.col("lo").cast("long"), 32) + F.col("shape") * 2 + F.col("hot").cast("int")
    wanted = open_.groupBy("at", "tie").agg(F.collect_list(F.struct("anchor", packed.alias("place"))).alias("wanted"))
    wanted = wanted.select("at", "tie", F.col("wanted.anchor").alias("anchors"), F.col("wanted.place").alias("places"))
    texts = body.select("at", "tie", "body")
    if repeated_ids:
        texts = texts.dropDuplicates(["at", "tie"])
    contents = stage(
        texts.join(wanted.hint("shuffle_hash"), ["at", "tie"]).mapInPandas(_contents, "anchor long, at long, tie long, lo int, shape int, hot boolean, content binary"), "open-contents"
    )
    span = "at long, tie long, start int, end int"
    merged = contents.filter("not hot").repartition("anchor").sortWithinPartitions("anchor").drop("hot").mapInPandas(_merger, span)
    strings = stage(contents.filter("hot").mapInPandas(_strings, "h1 long, h2 long, at long, tie long, lo int"), "hot-strings")
    earliest = strings.groupBy("h1", "h2").agg(F.min(F.struct("at", "tie", "lo")).alias("first"))
    late = strings.join(earliest, ["h1", "h2"]).filter(F.struct("at", "tie", "lo") != F.col("first"))
    late = late.select("at", "tie", F.col("lo").alias("start"), (F.col("lo") + LENGTH).cast("int").alias("end"))

    return spans.union(merged).union(late).groupBy("at", "tie").agg(F.collect_list(F.shiftleft(F.col("start").cast("long"), 32) + F.col("end")).alias("spans"))


def without_repeats(docs: DataFrame, doc_id="doc_id", text="text", hot: int = HOT, piece: int = PIECE) -> DataFrame:
    """Per document its id, ``n_bytes``, ``n_removed``, the ``removed`` byte runs [start, end) and the bytes ``kept``."""
    body = plain(docs, doc_id, text)
    found = repeated_spans(body, hot, piece)
    done = _identified(body)[0].join(found.hint("shuffle_hash"), ["at", "tie"], "left").select("key", "body", "spans")
    kind = body.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, kept binary"
    return done.mapInPandas(_remove, schema).withColumnRenamed("key", doc_id)


def _cleaned(position: int, names: list[str]):
    def run(batches):
        for batch in batches:
            columns = batch.column(0).flatten()
            spans = [s.values.to_numpy() if s.is_valid else None for s in batch.column(1)]
            bodies = columns[position].to_pylist()
            texts = [t if s is None else _cut(t.encode(), s)[1].decode("utf-8", "ignore") for t, s in zip(bodies, spans, strict=True)]
            columns[position] = pa.array(texts, columns[position].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def cleaned(docs: DataFrame, doc_id="doc_id", text="text", hot: int = HOT) -> DataFrame:
    """All rows and columns, the texts without their repeats; a character cut in two goes as a whole."""
    found = repeated_spans(plain(docs, doc_id, text), hot)
    # Own names beside the whole row as one value, so that no column of the table can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = _identified(docs.select(row, F.col(f"`{doc_id}`").alias("key"), F.col(f"`{text}`").alias("body")))[0]
    joined = own.join(found.hint("shuffle_hash"), ["at", "tie"], "left").select("row", "spans")
    return joined.mapInArrow(_cleaned(docs.columns.index(text), docs.columns), docs.schema)
