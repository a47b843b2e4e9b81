"""Log-bilinear language model, trained in numpy by noise-contrastive estimation.

Its outputs are the commonest tokens of the learning texts and classes of all others by their ending. The vectors of
the last ``CONTEXT`` outputs, each weighted by position, predict the next output's vector; one matrix product per
block of tokens gives all scores, which are normalised over all outputs. A token inside a class has its smoothed share
of the class, so every text has a log10 probability. Learning starts from a small sample on the driver and then goes
through all learning texts, every task on its own part; the parameters are averaged by the tokens behind them.

Token counts cover all learning texts. A bounded table of common tokens is broadcast; the counts of the rest are
joined, so no task holds the whole vocabulary.

Defined cases: a null or empty text is its end token alone; repeated rows each get their result; without any learning
text all tokens are unknown, all outputs alike.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import commonest, drawn, plain, slices, stage

END = "\n"  # no word holds white space
HEADS, CLASSES = 160, 96
WIDTH, CONTEXT = 16, 3
NOISE, BATCH = 48, 4096
RATE = 0.1
COMMON, LONG_WORD = 100_000, 64
START_DOCS = 400  # documents of the driver's start
SMOOTH = 0.1
BLOCK = 8192


def tokens(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words, A-Z lower-cased, as a dictionary array, and how many each text has (without the end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    ends = np.r_[0, np.cumsum(full)][lists.offsets.to_numpy()]
    return flat.filter(pa.array(full)).dictionary_encode(), np.diff(ends)


def _count(batches):
    for batch in batches:
        texts = batch.column("body").to_pylist()
        for a, b in slices(texts):
            coded, sizes = tokens(texts[a:b])
            counts = np.append(np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)), len(sizes))
            words = pa.concat_arrays([coded.dictionary, pa.array([END])])
            yield pa.RecordBatch.from_arrays([words, pa.array(counts, pa.int64())], ["token", "n"])


def token_counts(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(token, n) over all texts; the end of a text is the token END."""
    return plain(docs, doc_id, text).select("body").mapInArrow(_count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def class_of(token: str) -> int:
    return zlib.crc32(token.encode()[-3:]) % CLASSES


class Parameters:
    """Vectors of context outputs (one more for the start) and of predicted ones, weights per position, biases."""

    names = ("context", "position", "output", "bias")

    def __init__(self, share: np.ndarray, seed: int = 7):
        rng, k = np.random.default_rng(seed), len(share)
        self.share = share
        self.context = rng.normal(0, 0.1, (k + 1, WIDTH)).astype(np.float32)
        self.position = np.full((CONTEXT, WIDTH), 1 / CONTEXT, np.float32)
        self.output = rng.normal(0, 0.1, (k, WIDTH)).astype(np.float32)
        self.bias = np.log(share).astype(np.float32)
        self.seen = {n: np.full(getattr(self, n).shape, 0.1, np.float32) for n in self.names}

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.names])

    def filled(self, flat: np.ndarray) -> Parameters:
        at = 0
        for n in self.names:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def contexts(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The outputs before each token, the start where a text has not as many."""
        out = np.full((len(ids), CONTEXT), len(self.share), np.int64)
        for j in range(CONTEXT):
            before = ids[: max(0, len(ids) - j - 1)]
            out[j + 1 :, j] = np.where(place[j + 1 :] > j, before, len(self.share))
        return out

    def step(self, context: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> None:
        """One batch: the true outputs against noise from the unigram shares, which the batch has in common."""
        k, log_share = len(self.share), np.log(NOISE * self.share).astype(np.float32)
        noise = rng.choice(k, NOISE, p=self.share)
        vectors = self.context[context]
        predicted = (vectors * self.position).sum(axis=1)
        true = 1 / (1 + np.exp(-((predicted * self.output[target]).sum(axis=1) + self.bias[target] - log_share[target])))
        false = 1 / (1 + np.exp(-(predicted @ self.output[noise].T + self.bias[noise] - log_share[noise])))
        up = (1 - true).astype(np.float32)
        back = up[:, None] * self.output[target] - false @ self.output[noise]
        grads = {
            "bias": np.bincount(target, up, k) - np.bincount(noise, false.sum(axis=0), k),
            "output": self._gathered(target, up[:, None] * predicted, k) - self._gathered(noise, false.T @ predicted, k),
            "position": (back[:, None, :] * vectors).sum(axis=0),
            "context": self._gathered(context.ravel(), (back[:, None, :] * self.position).reshape(-1, WIDTH), k + 1),
        }
        for n, g in grads.items():
            g = (g / len(target)).astype(np.float32)
            self.seen[n] += g * g * 100
            getattr(self, n)[...] += RATE * g * 10 / np.sqrt(self.seen[n])

    @staticmethod
    def _gathered(at: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        """Sum of rows by place: one weighted count over (place, column)."""
        wide = (at[:, None] * WIDTH + np.arange(WIDTH)).ravel()
        return np.bincount(wide, rows.ravel(), k * WIDTH).reshape(k, WIDTH)

    def learn(self, ids: np.ndarray, place: np.ndarray, rng: np.random.Generator) -> None:
        context = self.contexts(ids, place)
        for at in range(0, len(ids), BATCH):
            self.step(context[at : at + BATCH], ids[at : at + BATCH], rng)

    def log10(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of every token's output."""
        context, out = self.contexts(ids, place), np.empty(len(ids))
        for at in range(0, len(ids), BLOCK):
            cut = slice(at, at + BLOCK)
            scores = (self.context[context[cut]] * self.position).sum(axis=1) @ self.output.T
            scores += self.bias
            own = scores[np.arange(len(scores)), ids[cut]]
            top = scores.max(axis=1)
            np.exp(np.subtract(scores, top[:, None], out=scores), out=scores)
            out[cut] = (own - top - np.log(scores.sum(axis=1))) / np.log(10)
        return out


class Vocabulary:
    """Outputs of the commonest tokens, and the counts of the common ones."""

    def __init__(self, common: list[tuple[str, int]], total: int, distinct: int, class_mass: np.ndarray, class_types: np.ndarray):
        self.count = dict(common)
        heads = [t for t, _ in common[:HEADS]]
        self.head = {t: i for i, t in enumerate(heads)}
        self.total, self.distinct = total, distinct
        for t, n in common[:HEADS]:
            class_mass[class_of(t)] -= n
            class_types[class_of(t)] -= 1
        # Within a class the types seen and one for all unseen share its smoothed mass, as in the base over all tokens.
        self.class_total = class_mass + SMOOTH * (class_types + 1)
        weight = np.concatenate([[n + SMOOTH for _, n in common[:HEADS]], self.class_total])
        self.share = weight / weight.sum()

    def arrays(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct word: its output, log10(c + smooth), c > 0, and whether its count must be joined."""
        count = [self.count.get(w, -1) for w in words]
        head = [self.head.get(w, -1) for w in words]
        output = np.array([h if h >= 0 else len(self.head) + class_of(w) for h, w in zip(head, words, strict=True)], np.int64)
        c = np.array(count, np.int64)
        return output, np.log10(np.maximum(c, 0) + SMOOTH), c > 0, c < 0


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Built from sums over all counted tokens and a bounded table of common ones."""
    short = counts.filter(F.octet_length("token") <= LONG_WORD)
    common = commonest(short, "token", "n", COMMON)
    ending = F.substring(F.col("token").cast("binary"), F.greatest(F.octet_length("token") - 2, F.lit(1)), F.lit(3))
    by_class = counts.groupBy(F.pmod(F.crc32(ending), F.lit(CLASSES)).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    mass, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class.collect():
        mass[r.c], types[r.c] = r.n, r.types
    return Vocabulary(common, int(mass.sum()), int(types.sum()), mass, types)


def outputs(texts: list[str], known: Vocabulary):
    """Tokens of the texts with their ends: codes into the distinct words, those words, and per text its length."""
    coded, sizes = tokens(texts)
    words = [*coded.dictionary.to_pylist(), END]
    codes = np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(sizes), len(words) - 1)
    lengths = sizes + 1
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return codes, words, lengths, place


def _learner(shared):
    def run(batches):
        known, flat, seen = shared.value
        model = Parameters(known.share).filled(flat)
        model.seen = {n: v.copy() for n, v in seen.items()}
        rng, held = np.random.default_rng(TaskContext.get().partitionId()), 0
        for pdf in batches:
            texts = pdf["body"].tolist()
            for a, b in slices(texts):
                codes, words, _, place = outputs(texts[a:b], known)
                model.learn(known.arrays(words)[0][codes], place, rng)
                held += len(codes)
        if held:
            value = model.flat().astype(np.float64)
            yield pd.DataFrame({"slot": np.arange(len(value)), "value": value * held, "held": float(held)})

    return run


def train(docs: DataFrame, counts: DataFrame, doc_id="doc_id", text="text") -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and parameters from all rows given."""
    known = vocabulary(counts)
    body = plain(docs, doc_id, text)
    model, rng = Parameters(known.share), np.random.default_rng(1)
    first = [r.body for r in drawn(body, F.xxhash64("key", "body"), START_DOCS).collect()]
    for _ in range(3):
        for a, b in slices(first):
            codes, words, _, place = outputs(first[a:b], known)
            model.learn(known.arrays(words)[0][codes], place, rng)
    shared = docs.sparkSession.sparkContext.broadcast((known, model.flat(), model.seen))
    learned = body.select("body").mapInPandas(_learner(shared), "slot int, value double, held double")
    mean = learned.groupBy("slot").agg((F.sum("value") / F.sum("held")).alias("value")).collect()
    flat = model.flat()
    for r in mean:
        flat[r.slot] = r.value
    return known, flat


def _scorer(shared):
    def run(batches):
        known, flat = shared.value
        model = Parameters(known.share).filled(flat)
        row = TaskContext.get().partitionId() << 33
        class_log = np.concatenate([np.zeros(len(known.head)), np.log10(known.class_total)])
        for pdf in batches:
            texts, keys = pdf["body"].tolist(), pdf["key"]
            for a, b in slices(texts):
                codes, words, lengths, place = outputs(texts[a:b], known)
                output, log_count, seen, joined = (x[codes] for x in known.arrays(words))
                starts = np.cumsum(lengths) - lengths
                model_log = model.log10(output, place)
                in_class = output >= len(known.head)
                # What is known here; tokens whose count is joined later add their own log10(c + smooth) to both sums.
                here = np.where(joined, 0.0, log_count)
                ids = row + np.arange(b - a)
                yield pd.DataFrame({
                    "row": ids, "key": keys.iloc[a:b].to_numpy(), "token": [f"{END}{i}" for i in ids], "n": 0, "n_tokens": lengths,
                    "n_known": np.add.reduceat(seen.astype(np.int64), starts), "base": np.add.reduceat(here, starts),
                    "model": np.add.reduceat(model_log + np.where(in_class, here - class_log[output], 0.0), starts),
                })
                rare = np.flatnonzero(joined)
                owner = np.repeat(np.arange(b - a), lengths)[rare]
                pair, many = np.unique(owner * len(words) + codes[rare], return_counts=True)
                for at in range(0, len(pair), 50_000):
                    p, n = pair[at : at + 50_000], many[at : at + 50_000]
                    yield pd.DataFrame({
                        "row": row + p // len(words), "key": keys.iloc[a:b].to_numpy()[p // len(words)], "token": [words[i] for i in (p % len(words)).tolist()],
                        "n": n, "n_tokens": 0, "n_known": 0, "base": 0.0, "model": 0.0,
                    })
                row += b - a

    return run


def score(docs: DataFrame, counts: DataFrame, known: Vocabulary, flat: np.ndarray, doc_id="doc_id", text="text") -> DataFrame:
    """Per document ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10)."""
    body = plain(docs, doc_id, text)
    key = body.schema["key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((known, flat))
    rows = body.mapInPandas(_scorer(shared), f"row long, key {key}, token string, n long, n_tokens long, n_known long, base double, model double")
    # Rows that carry a document's own sums have a token of their own, so that they spread over the join as well.
    counted = rows.join(counts.select("token", F.col("n").alias("c")), "token", "left")
    log_count = F.when(F.col("n") > 0, F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).otherwise(0.0)
    whole = float(np.log10(known.total + SMOOTH * (known.distinct + 1)))
    summed = counted.groupBy("row", "key").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + log_count).alias("base"),
        F.sum(F.col("model") + log_count).alias("score"),
    )
    return summed.select(
        F.col("key").alias(doc_id), "n_tokens", "n_known", F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"), "score",
    )


def learned(docs: DataFrame, doc_id="doc_id", text="text") -> tuple[DataFrame, Vocabulary, np.ndarray]:
    """Token counts (written once), vocabulary and parameters of all rows given."""
    counts = stage(token_counts(docs, doc_id, text), "token-counts")
    return counts, *train(docs, counts, doc_id, text)
