import random

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabsift.modelling import skip_gram, vectors


def _two_topics(spark):
    """Texts of two sets of words that never meet, each with a word of its own, one empty text and a short one."""
    draw = random.Random(1)
    sides = [[f"{s}{i}" for i in range(20)] for s in "ab"]
    rows = [(i, " ".join([*draw.choices(sides[i % 2], k=15), f"z{i}"])) for i in range(3_000)]
    return spark.createDataFrame([*rows, (3_000, ""), (3_001, "a1 a1 B1")], "i long, text string")


def test_words_beyond_the_driver_are_learned_in_tables(spark, monkeypatch, tmp_path):
    d = _two_topics(spark)
    monkeypatch.setattr(vectors, "VOCABULARY_BYTES", 1_000)
    model = vectors.word_vectors(d, "text", dims=8, partitions=3)
    learned = model.stages[-1]
    assert isinstance(learned, skip_gram.WordVectors) and learned.getOrDefault("numPartitions") == 3
    of = {r["word"]: r["vector"].toArray() for r in learned.getVectors().collect()}
    assert len(of) == 3_040  # every word has one vector
    unit = {w: v / np.linalg.norm(v) for w, v in of.items() if w[0] in "ab"}
    near = lambda s, t: np.mean([unit[v] @ unit[w] for v in unit for w in unit if v != w and (v[0], w[0]) == (s, t)])
    assert near("a", "a") > 0.9 and near("b", "b") > 0.9 and near("a", "b") < 0.5
    probe = spark.createDataFrame([(1, "a1 a1 b1 nowhere"), (2, ""), (3, "a1 a1 b1 nowhere"), (4, "?!")], "i long, text string")
    got = {r["i"]: r["text_vector"].toArray() for r in vectors.text_features(model, probe).collect()}
    want = (2 * of["a1"] + of["b1"]) / 4
    assert np.allclose(got[1], want) and np.allclose(got[3], want) and not got[2].any() and not got[4].any()
    model.write().save(str(tmp_path / "model"))
    again = vectors.text_features(PipelineModel.load(str(tmp_path / "model")), probe)
    assert all(np.allclose(r["text_vector"].toArray(), got[r["i"]]) for r in again.collect())


def test_rare_words_are_left_out_of_tables(spark, monkeypatch):
    monkeypatch.setattr(vectors, "VOCABULARY_BYTES", 1_000)
    model = vectors.word_vectors(_two_topics(spark), "text", dims=4, partitions=2, iterations=1, min_count=2)
    assert model.stages[-1].getVectors().count() == 40


def test_no_code_begins_another(spark, monkeypatch):
    monkeypatch.setattr(skip_gram, "BUCKET_WORDS", 7)
    counts = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate([64, 16, 16, 16, 8, 3, 2] + [1] * 50)], "word string, n long")
    keys = {r["word"]: r["key"] for r in skip_gram._coded(counts).collect()}
    assert len(set(keys.values())) == len(keys) == 57
    assert keys["w0"].bit_length() - 1 == 2 and max(keys.values()).bit_length() - 1 == 8  # 175 uses: shares of 64 and of 1
    names = sorted(keys.values())
    above = {k >> d for k in names for d in range(1, k.bit_length())}
    assert not above & set(names)
    assert skip_gram._coded(counts.limit(1)).first()["key"] == 2  # a single word still has a bit
    words = np.array(sorted(names, key=lambda k: k << (62 - k.bit_length())))
    path, turn, nodes = skip_gram._paths(words)
    assert set(nodes.tolist()) == above and len(nodes) == len(above)
    for w, p, t in zip(words.tolist(), path, turn, strict=True):
        bits = w.bit_length() - 1
        assert [nodes[i] for i in p[:bits]] == [w >> (bits - d) for d in range(bits)] and (p[bits:] == len(nodes)).all()
        assert t[:bits].tolist() == [(w >> (bits - d - 1)) & 1 for d in range(bits)] and (t[bits:] == -1).all()
