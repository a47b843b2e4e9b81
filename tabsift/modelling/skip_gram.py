"""Word vectors over vocabularies that no single process can hold.

Skip-gram with hierarchical softmax, as Spark's Word2Vec has it, but words, codes and vectors stay in tables: a task
holds the words of its own part of the texts and the nodes above them, and nothing of a word passes through the driver.
A word that makes up the share q of all tokens has a code of ceil(-log2 q) bits, given out in order, so a code follows
from the word's place among those of its length. A word and the nodes above it are named by one whole number, 1 and the
bits so far, and the nodes of a word are what shifting its name leaves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import released, staged

# As in Spark's Word2Vec: words on either side, first step, words of a sentence, and the products beyond which nothing is learned.
WINDOW = 5
RATE = 0.025
SENTENCE_WORDS = 1_000
SATURATED = 6.0
# Words whose steps are worked out together, of a stretch sorted by the length of their codes, and steps that a vector
# takes of one batch; of more their mean counts so often.
BATCH_WORDS = 256
STRETCH_WORDS = 2_048
BATCH_STEPS = 64
# Bytes of text that a task learns from.
PART_BYTES = 16 * 1024 * 1024
# Words that are numbered in one window.
BUCKET_WORDS = 100_000
# Rows that a task hands over at a time.
SENT_ROWS = 50_000


def fit(texts: DataFrame, words: str, dims: int, seed: int, iterations: int, parts: int, counts: DataFrame, out: str) -> WordVectors:
    """Vectors of the words of ``texts`` that ``counts`` (word, n) lists; the written table ``texts`` is used up.

    Parts learn by themselves; after every iteration a vector becomes its mean over the parts that have it.
    """
    spark, absent = texts.sparkSession, lambda name, kind: F.lit(None).cast(kind).alias(name)
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int").alias("part")  # by place in the table
    dealt = texts.select(part, F.col(f"`{words}`").alias("words"))
    coded = staged(_coded(counts), "words", dealt=True)
    own = staged(dealt.select("part", F.explode("words").alias("word")).distinct().join(coded, "word").select("part", "word", "key"), "own", dealt=True)
    both = dealt.select("part", "words", absent("word", "string"), absent("key", "long")).unionAll(
        own.select("part", absent("words", "array<string>"), "word", "key")
    )
    codes = staged(both.repartitionById(parts, "part").mapInArrow(_encoder, "part int, codes array<bigint>"), "codes", dealt=True)
    released(spark, texts)
    known = own.select("part", "key", absent("v", "binary"))

    def learned(known: DataFrame, i: int) -> DataFrame:
        rows = codes.select("part", "codes", absent("key", "long"), absent("v", "binary")).unionAll(
            known.select("part", absent("codes", "array<bigint>"), "key", "v")
        )
        moved = rows.repartitionById(parts, "part").mapInArrow(_learner(dims, seed, i, iterations), _MOVED)
        last = i + 1 == iterations
        return staged(moved.repartition(parts, "key").mapInArrow(_averager(dims, last), _LEARNED if last else _MOVED), "moved", dealt=True)

    for i in range(iterations):
        after = learned(known, i)
        released(spark, known)
        known = after
    found = staged(coded.join(known, "key").select("word", "v"), "vectors", dealt=True)
    released(spark, codes, coded, known)
    return WordVectors(inputCol=words, outputCol=out, vectorSize=dims, numPartitions=parts).holding(found)


# What a part learned, with the vectors as bytes of half precision until the last mean, and what comes of it.
_MOVED = "part int, key bigint, v binary, is_word boolean"
_LEARNED = "key bigint, v array<float>"


def _averager(dims: int, last: bool):
    """The rows of a task's keys with each key's mean over the parts; after the last iteration one row per word."""

    def run(batches):
        tables = [t for t in batches if len(t)]
        if not tables:
            return
        part, key, word = (_column(tables, c).to_numpy(zero_copy_only=False) for c in ("part", "key", "is_word"))
        v = np.concatenate([_numbers(t.column("v")) for t in tables]).reshape(len(key), dims)
        del tables
        names, first, place, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        mean = v[first].astype(np.float64)
        again = np.ones(len(key), bool)
        again[first] = False  # most keys are in one part only
        np.add.at(mean, place[again], v[again])
        mean = (mean / n[:, None]).astype(np.float32)
        if not last:
            yield from _batches(part, key, mean, place, word)
            return
        names, mean = names[word[first]], mean[word[first]]
        for at in range(0, len(names), SENT_ROWS):
            some = mean[at : at + SENT_ROWS]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dims), pa.array(some.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(names[at : at + SENT_ROWS]), lists], ["key", "v"])

    return run


def _numbers(column: pa.Array) -> np.ndarray:
    """The bytes of a column as one array of numbers of half precision; missing values have none."""
    _, ends, held = column.cast(pa.binary()).buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(held, np.uint8)[ends[0] : ends[-1]].view(np.float16) if held is not None else np.zeros(0, np.float16)


def _batches(part, key, vectors, place, word):
    """Rows of _MOVED with the vectors at their places."""
    width = vectors.shape[1] * 2
    for at in range(0, len(key), SENT_ROWS):
        some = slice(at, at + SENT_ROWS)
        v = vectors[place[some]].astype(np.float16)
        ends = pa.py_buffer(np.arange(len(v) + 1, dtype=np.int32) * width)
        held = pa.Array.from_buffers(pa.binary(), len(v), [None, ends, pa.py_buffer(v)])
        yield pa.RecordBatch.from_arrays([pa.array(part[some]), pa.array(key[some]), held, pa.array(word[some])], ["part", "key", "v", "is_word"])


def _coded(counts: DataFrame) -> DataFrame:
    """Words with ``key``: 1 and the bits of the word's code. No code begins another, as the shares add up to 1."""
    total, n_words = counts.agg(F.sum("n"), F.count("*")).first()
    least = [-(-total // (1 << bits)) for bits in range(63)]  # uses that a code of so few bits asks for
    bits = F.greatest(F.lit(1), F.size(F.filter(F.array(*[F.lit(t) for t in least]), lambda t: t > F.col("n"))))
    bucket = F.pmod(F.xxhash64("word"), F.lit(1 + n_words // BUCKET_WORDS))
    laid = staged(counts.select("word", bits.alias("bits"), bucket.alias("bucket")), "lengths", dealt=True)
    sizes = sorted(laid.groupBy("bits", "bucket").agg(F.count("*").alias("n")).collect())  # a row per length and bucket
    code, at, begins = 0, 0, []
    for r in sizes:
        code, at = code << (r.bits - at), r.bits
        begins.append((r.bits, r.bucket, (1 << at) + code))
        code += r.n
    first = F.broadcast(counts.sparkSession.createDataFrame(begins, "bits int, bucket long, first long"))
    place = F.row_number().over(W.partitionBy("bits", "bucket").orderBy("word")) - 1
    return laid.withColumn("place", place).join(first, ["bits", "bucket"]).select("word", (F.col("first") + F.col("place")).alias("key"))


def _column(tables: list[pa.RecordBatch], name: str) -> pa.Array:
    return pa.concat_arrays([t.column(name) for t in tables])


def _of_part(batches):
    """Batches of a task's partition by part: with one part per partition there is one group."""
    held: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        parts = batch.column("part").to_numpy()
        for p in np.unique(parts).tolist():
            held.setdefault(p, []).append(batch.filter(pa.array(parts == p)))
    while held:
        yield held.popitem()


def _encoder(batches):
    """Texts as keys; words without one are left out."""
    for part, tables in _of_part(batches):
        rows = [t for t in (t.filter(pc.is_valid(t.column("word"))) for t in tables) if len(t)]
        if not rows:
            continue
        names, keys = _column(rows, "word"), _column(rows, "key").to_numpy()
        for t in tables:
            lists = t.column("words").drop_null()
            if not len(lists):
                continue
            ends = lists.value_lengths().to_numpy().cumsum()
            places = pc.index_in(lists.flatten(), value_set=names)
            there = places.is_valid().to_numpy(zero_copy_only=False)
            left = np.concatenate([[0], np.concatenate([[0], there.cumsum()])[ends]]).astype(np.int32)
            codes = pa.ListArray.from_arrays(pa.array(left), pa.array(keys[places.drop_null().to_numpy()]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), part, np.int32)), codes], ["part", "codes"])


def _bits(keys: np.ndarray) -> np.ndarray:
    return np.frexp(keys.astype(np.float64))[1].astype(np.int64) - 1  # whole numbers far below 2^53


def _paths(words: np.ndarray):
    """Per word the places of the nodes above it (beyond its own: one past the last) and its turns (-1), and the nodes' keys.

    Words are in the order of their codes, so the words below a node lie side by side.
    """
    bits = _bits(words)
    path = np.full((len(words), bits.max()), -1, np.int32)
    turn = np.full(path.shape, -1, np.int8)
    nodes, at = [], 0
    for d in range(path.shape[1]):
        below = np.flatnonzero(bits > d)
        rest = bits[below] - d
        above = words[below] >> rest
        new = np.concatenate([[True], above[1:] != above[:-1]])
        path[below, d] = at + np.cumsum(new) - 1
        turn[below, d] = (words[below] >> (rest - 1)) & 1
        nodes.append(above[new])
        at += len(nodes[-1])
    path[path < 0] = at
    return path, turn, np.concatenate(nodes)


def _fresh(keys: np.ndarray, dims: int, seed: int) -> np.ndarray:
    """Small random vectors that follow from the key, so that all parts begin alike."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + (np.arange(dims, dtype=np.uint64) + np.uint64(1 + seed)) * np.uint64(0xBF58476D1CE4E5B9)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (((x >> np.uint64(11)) * 2.0**-53 - 0.5) / dims).astype(np.float32)


def _learner(dims: int, seed: int, iteration: int, iterations: int):
    def run(batches):
        for part, tables in _of_part(batches):
            lists = [c for c in (t.column("codes").drop_null() for t in tables) if len(c)]
            if not lists:
                continue
            lengths = np.concatenate([c.value_lengths().to_numpy() for c in lists]).astype(np.int64)
            tokens = np.concatenate([c.flatten().to_numpy() for c in lists])
            if not len(tokens):
                continue
            words = np.unique(tokens)
            order = np.argsort(words << (62 - _bits(words)))
            words, place = words[order], np.empty(len(words), np.int32)
            place[order] = np.arange(len(words), dtype=np.int32)
            tokens = place[np.searchsorted(words[place], tokens)]  # words[place] are the words in ascending order
            path, turn, nodes = _paths(words)
            vectors, weights = _fresh(words, dims, seed), np.zeros((len(nodes) + 1, dims), np.float32)
            for t in tables:
                t = t.filter(pc.is_valid(t.column("v")))
                if not len(t):
                    continue
                keys, v = t.column("key").to_numpy(), _numbers(t.column("v")).reshape(len(t), dims)
                for names, into in ((words, vectors), (nodes, weights)):
                    ascending = np.argsort(names)
                    spot = np.minimum(np.searchsorted(names, keys, sorter=ascending), len(names) - 1)
                    known = names[ascending[spot]] == keys
                    into[ascending[spot[known]]] = v[known]
            del tables[:]
            starts = np.cumsum(lengths) - lengths
            within = np.arange(len(tokens)) - np.repeat(starts, lengths)
            sentence = np.cumsum(within % SENTENCE_WORDS == 0, dtype=np.int32)
            _learn(tokens, sentence, path, turn, vectors, weights, np.random.default_rng([seed, iteration, part]), iteration, iterations)
            for names, v, is_word in ((words, vectors, True), (nodes, weights, False)):
                n = len(names)
                yield from _batches(np.full(n, part, np.int32), names, v, np.arange(n), np.full(n, is_word))

    return run


def _learn(tokens, sentence, path, turn, vectors, weights, rng, iteration: int, iterations: int) -> None:
    """One pass: every word's path is predicted from each word near it, at a distance drawn per word, and both sides move."""
    n, dims = len(tokens), vectors.shape[1]
    away = np.array([o for o in range(-WINDOW, WINDOW + 1) if o])
    cells = np.arange(dims)
    flat, flat_weights = vectors.reshape(-1), weights.reshape(-1)
    steps, node_steps = np.zeros(len(vectors), np.float32), np.zeros(len(weights), np.float32)
    deep = (turn >= 0).sum(axis=1)
    stretches = (at + np.argsort(deep[tokens[at : at + STRETCH_WORDS]], kind="stable") for at in range(0, n, STRETCH_WORDS))
    for here in (stretch[at : at + BATCH_WORDS] for stretch in stretches for at in range(0, len(stretch), BATCH_WORDS)):
        near = here[:, None] + away
        near = np.clip(near, 0, n - 1, out=near)
        reach = rng.integers(1, WINDOW + 1, len(here))
        used = (sentence[near] == sentence[here, None]) & (np.abs(away) <= reach[:, None]) & (near != here[:, None])
        used &= near == here[:, None] + away  # not beyond the ends
        rate = np.float32(max(RATE * (1 - (iteration + here[0] / n) / iterations), RATE * 1e-4))
        side, above, turns = tokens[near], path[tokens[here]], turn[tokens[here]]
        longest = deep[tokens[here[-1]]]
        above, turns = above[:, :longest], turns[:, :longest]
        x, y = vectors[side], weights[above]
        f = x @ y.transpose(0, 2, 1)
        with np.errstate(over="ignore"):
            g = rate * ((1 - turns)[:, None, :] - 1 / (1 + np.exp(-f)))
        g *= used[:, :, None] & (turns >= 0)[:, None, :] & (np.abs(f) < SATURATED)
        moves, node_moves = g @ y, g.transpose(0, 2, 1) @ x
        for into, counted, at_rows, move, times in (
            (flat, steps, side, moves, used.astype(np.float32)),
            (flat_weights, node_steps, above, node_moves, np.broadcast_to(used.sum(axis=1, dtype=np.float32)[:, None], above.shape)),
        ):
            rows = at_rows.ravel()
            np.add.at(counted, rows, times.ravel())
            held = np.minimum(1, BATCH_STEPS / np.maximum(counted[rows], 1)).astype(np.float32)
            counted[rows] = 0
            np.add.at(into, (rows.astype(np.int64)[:, None] * dims + cells).ravel(), (move.reshape(-1, dims) * held[:, None]).ravel())


class WordVectors(Model, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """The mean of the vectors of a text's words; unknown ones count as zeros, as in Spark's Word2Vec.

    Words are counted per text and meet their vectors in a join; texts with the same words are one.
    """

    vectorSize = Param(Params._dummy(), "vectorSize", "parts of a vector", TypeConverters.toInt)
    numPartitions = Param(Params._dummy(), "numPartitions", "parts of the texts that learned by themselves", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, vectorSize=None, numPartitions=None):
        super().__init__()
        self.vectors: DataFrame | None = None
        self._set(**self._input_kwargs)

    def holding(self, vectors: DataFrame) -> WordVectors:
        """With the table (word, v) of its vectors."""
        self.vectors = vectors
        return self

    def getVectors(self) -> DataFrame:
        return self.vectors.select("word", array_to_vector(F.col("v").cast("array<double>")).alias("vector"))

    def copy(self, extra=None) -> WordVectors:
        return super().copy(extra).holding(self.vectors)

    def _transform(self, df: DataFrame) -> DataFrame:
        dims, words = self.getOrDefault("vectorSize"), F.col(f"`{self.getInputCol()}`")
        keyed = df.withColumn("_text", F.sha2(F.array_join(words, "\0"), 256))
        used = keyed.select("_text", F.explode(words).alias("word")).groupBy("_text", "word").agg(F.count("*").alias("_n"))
        met = used.join(self.vectors, "word", "left")
        sums = met.groupBy("_text").agg(F.sum("_n").alias("_n"), *[F.sum(F.col("_n") * F.col("v")[j]).alias(f"_s{j}") for j in range(dims)])
        mean = F.array(*[F.coalesce(F.col(f"_s{j}") / F.col("_n"), F.lit(0.0)) for j in range(dims)])
        sums = sums.select("_text", mean.alias("_mean"))
        none = F.array(*[F.lit(0.0)] * dims)
        vector = array_to_vector(F.coalesce("_mean", none))
        return keyed.join(sums, "_text", "left").withColumn(self.getOutputCol(), vector).drop("_text", "_mean")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: WordVectors):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.vectors.write.parquet(f"{path}/vectors")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> WordVectors:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model.holding(self.sparkSession.read.parquet(f"{path}/vectors"))
