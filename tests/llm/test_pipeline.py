"""Every pipeline stage against a brute-force version of it, on whole tables and on odd rows."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

import corpus_pipeline
from tabsift.llm import language
from tabsift.llm.common import remainder, stage

from .test_operators_llm import slow_components, slow_fingerprint, slow_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def keep_known(rows, model):
    return [r for r in rows if not model.predict([r.text or ""])[2][0]]


def one_of_each_group(rows):
    groups, least = slow_components([slow_fingerprint(r.text) for r in rows]), {}
    for r, g in zip(rows, groups, strict=True):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    return [r for r, g in zip(rows, groups, strict=True) if least[g] == r.doc_id]


def cleaned(rows):
    kept = slow_repeats([(r.doc_id, r.text) for r in sorted(rows, key=lambda r: r.doc_id)])
    return {r.doc_id: kept[r.doc_id][2].decode("utf-8", "ignore") for r in rows}


def contaminated(text, items):
    own = words(text)
    windows = {}
    for item in items:
        n = min(10, len(item))
        windows.setdefault(n, set()).update(tuple(item[i : i + n]) for i in range(len(item) - n + 1))
    return any(tuple(own[i : i + n]) in w for n, w in windows.items() if n for i in range(len(own) - n + 1))


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language", "near_duplicates", "repeats", "decontamination", "tokens"]
    model = language.train(docs.filter(remainder("doc_id", 4) != 2))

    def run(name, df):
        out = steps[name](spark, df, sf_dir)
        if name != "tokens":
            assert out.columns == COLUMNS and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
        out = stage(out, "test-stage")
        return out, out.collect()

    rows = docs.collect()
    docs, got = run("language", docs)
    assert sorted(got) == sorted(keep_known(rows, model))
    docs, after = run("near_duplicates", docs)
    assert sorted(after) == sorted(one_of_each_group(got)) and len(after) < len(got)
    docs, texts = run("repeats", docs)
    assert {r.doc_id: r.text for r in texts} == cleaned(after)
    assert all(r.n_chars == len(r.text) for r in texts) and sum(r.n_chars for r in texts) < sum(r.n_chars for r in after)
    docs, clean = run("decontamination", docs)
    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(clean) == sorted(r for r in texts if not contaminated(r.text, items))
    _, coded = run("tokens", docs)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in clean}
    assert {r.doc_id: r.ids for r in coded} == want
    text_of = {r.doc_id: r.text for r in clean}
    assert all(r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(text_of[r.doc_id].encode()).hexdigest() for r in coded)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, sf_dir, odd, nothing, name):
    step = dict(corpus_pipeline.STAGES)[name]
    out = step(spark, odd, sf_dir)
    found = out.collect()
    assert step(spark, nothing, sf_dir).collect() == []
    if name == "tokens":
        assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd.collect())
    else:
        assert out.columns == odd.columns
    if name == "near_duplicates":
        texts = [(r.text or "").lower().split() for r in found]
        assert len({tuple(t) for t in texts}) == len(texts)  # one of each set of equal texts, ids or not
