"""Merkle manifest, Jaccard join and ranked search against brute-force versions, and on odd, empty and clashing input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsift.llm import count_rtree, merkle, ranked_search
from tabsift.llm.common import remainder

from .conftest import prose

LOWER = {c: c + 32 for c in range(65, 91)}


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# -- 11 Merkle manifest


def slow_leaf(r, text):
    fields = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def slow_tree(nodes, fan):
    """The root, and per node the levels of (siblings, place) on its way."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            a = i - i % fan
            run = nodes[a : a + fan]
            path.append((run[: i - a] + run[i - a + 1 :], i - a))
        nodes = [sha(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        at = [i // fan for i in at]
    return nodes[0], paths


def slow_manifest(docs, fan):
    by_lang = defaultdict(list)
    for r in docs:
        by_lang[r.lang].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted(((r.doc_id is not None, r.doc_id or 0, slow_leaf(r, r.text), r) for r in by_lang[lang]), key=lambda x: x[:3])
        trees[lang] = (mine, *slow_tree([x[2] for x in mine], fan))
    root, upper = slow_tree([trees[lang][1] for lang in langs], fan)
    out = []
    for lang, above in zip(langs, upper, strict=True):
        mine, subroot, paths = trees[lang]
        for (_, _, leaf, r), path in zip(mine, paths, strict=True):
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
            node = slow_leaf(r, r.text.translate(LOWER)) if bad else leaf
            for siblings, place in path + above:
                node = sha(*siblings[:place], node, *siblings[place:])
            proof = sha(*[s for siblings, _ in path + above for s in siblings])
            out.append((r.doc_id, leaf, subroot, root, proof, node, node == root))
    return out


def manifest(docs, **sizes):
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    small = {"text": F.translate("text", capitals, capitals.lower())}
    return merkle.manifest(merkle.leaves(docs, presented=small, where=remainder("doc_id", 3) == 0), **sizes)


@pytest.mark.parametrize("fan, levels", [(8, 4), (3, 1), (2, 2)])
def test_manifest_equals_brute_force(spark, make, monkeypatch, fan, levels):
    monkeypatch.setattr(merkle, "PART_ROWS", 40)  # several ranges
    rng = random.Random(fan)
    langs = [None, "", "a", "é", "z"] + [f"l{i}" for i in range(12)]
    data = [(i, rng.choice([None, "", f"Text {i}", prose(i, 5).title()]), "en" if i % 2 else rng.choice(langs)) for i in range(150)]
    data += [(7, "same id", "en"), (None, "no id", "en"), (None, None, None), (3, "twin", "x"), (3, "twin", "x")]
    docs = make(data)
    got = manifest(docs, fan=fan, levels=levels)
    assert got.columns == ["key", "subroot", "root", "leaf", "proof_sha256", "folded_root", "verified"]
    names = ("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert Counter(tuple(r[n] for n in names) for r in rows(got)) == Counter(slow_manifest(docs.collect(), fan))


def test_manifest_of_odd_and_empty_tables(make, odd, nothing):
    got = rows(manifest(odd, proofs=True))
    names = ("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(slow_manifest(odd.collect(), 8))
    for r in got:  # whole proofs lead back to the root
        assert merkle.fold(r["leaf"], r["siblings"], r["places"], r["widths"]) == r["root"]
        assert sha(*r["siblings"]) == r["proof_sha256"]
    assert rows(manifest(nothing)) == []
    one = rows(merkle.manifest(merkle.leaves(make([(5, "only")]))))[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["verified"] and one["proof_sha256"] == sha("")


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "x", "en"), ("a", "y", "en"), (None, "z", "en")], "name string, text string, lang string")
    got = rows(merkle.manifest(merkle.leaves(docs, "name", fields=["name", "text"])))
    leaves = [sha("-", "1:z"), sha("1:a", "1:y"), sha("1:b", "1:x")]
    assert {r["key"]: r["leaf"] for r in got} == dict(zip([None, "a", "b"], leaves, strict=True))
    assert {r["root"] for r in got} == {sha(*leaves)}


# -- 12 Jaccard join


def slow_set(text, width=3):
    words = (text or "").encode().lower().split()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def slow_linked(texts, width=3, percent=90):
    """Per text its set's size and the group of texts it belongs to."""
    sets = [slow_set(t, width) for t in texts]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def check_linked(docs, **options):
    data = docs.collect()
    found = slow_linked([r.text for r in data], options.get("width", 3), options.get("percent", 90))
    least = {}
    for r, (_, g) in zip(data, found, strict=True):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    got = count_rtree.linked(docs, **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want = Counter((r.doc_id, n, least.get(g) if n else r.doc_id) for r, (n, g) in zip(data, found, strict=True))
    assert Counter(tuple(r) for r in got.collect()) == want
    return found


def variant(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_links_equal_brute_force(make):
    rng = random.Random(4)
    data = [(i, variant(prose(i // 6, 90 + 20 * (i % 5 == 0), 5000).split(), rng, rng.randint(0, 3))) for i in range(120)]
    data += [(200 + i, prose(9, 12)[: 40 + i]) for i in range(20)] + [(300, "A b"), (301, "a  B"), (302, "a"), (303, "a b c"), (303, "a b c")]
    found = check_linked(make(data))
    assert 1 < len({g for _, g in found}) < len(data) - 20
    check_linked(make(data), width=2, percent=70)


def test_links_without_pivots_and_with_split_signatures(make, monkeypatch):
    """Trees alone find all links, also where one signature is shared by more nodes than a shard holds."""
    rng = random.Random(6)
    base = prose(77, 110, 5000).split()
    data = [(i, variant(base, rng, rng.randint(0, 3))) for i in range(90)] + [(500 + i, prose(i, 60, 5000)) for i in range(30)]
    stars = count_rtree.Join.star
    monkeypatch.setattr(count_rtree.Join, "star", lambda self, rows, turn: stars(self, rows, turn).limit(0))
    monkeypatch.setattr(count_rtree, "LEAF", 4)
    check_linked(make(data), shard=16)


def test_a_pair_does_not_come_out_once_per_signature(make, monkeypatch):
    rng = random.Random(14)
    base = prose(78, 400, 5000).split()
    stars, stage, made = count_rtree.Join.star, count_rtree.stage, {}

    def counted(df, label):
        out = stage(df, label)
        made[label] = (out.count(), out.distinct().count()) if label == "pairs" else None
        return out

    monkeypatch.setattr(count_rtree.Join, "star", lambda self, rows, turn: stars(self, rows, turn).limit(0))
    monkeypatch.setattr(count_rtree, "stage", counted)
    check_linked(make([(i, variant(base, rng, 4)) for i in range(24)]), shard=32)
    rows_made, pairs = made["pairs"]
    assert pairs > 200 and rows_made < 4 * pairs


def test_links_of_odd_and_empty_tables(odd, nothing):
    check_linked(odd)
    assert rows(count_rtree.linked(nothing)) == []


def test_a_signature_is_shared_by_every_linked_pair():
    rng = random.Random(8)
    for percent in (70, 80, 90, 95):
        edges = count_rtree.bands(percent, 4000)
        for _ in range(150):
            n = rng.randint(1, 300)
            a = np.array(sorted(rng.getrandbits(64) for _ in range(n)), np.uint64)
            drop = rng.randint(0, n - 1)
            keep = rng.sample(range(n), n - drop)
            b = np.unique(np.r_[a[keep], np.array([rng.getrandbits(64) for _ in range(rng.randint(0, 20))], np.uint64)])
            if len(a) == len(b) == n - drop or not count_rtree.enough(n - drop, len(a) + len(b), percent):
                continue
            x, y = (set(count_rtree.signatures(s, percent, edges).tolist()) for s in (a, b))
            assert x & y


@given(st.lists(st.lists(st.integers(0, 6), min_size=64, max_size=64), min_size=1, max_size=80), st.integers(50, 99))
@settings(max_examples=30, deadline=None)
def test_tree_finds_all_pairs_within_the_bound(raw, percent):
    points = np.array(raw, np.int32)
    sizes = points.sum(axis=1)
    want = {
        (i, j)
        for i in range(len(points))
        for j in range(len(points))
        if count_rtree.enough(int(np.minimum(points[i], points[j]).sum()), int(sizes[i] + sizes[j]), percent)
    }
    got = [(i, j) for q, p in count_rtree.Tree(points).search(points, points, percent) for i, j in zip(q.tolist(), p.tolist(), strict=True)]
    assert set(got) == want and len(got) == len(want)


# -- 13 ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_search(docs, items, k=20):
    """Rows (item, rank, id, score) by the definition."""
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n = sum(1 for _, t in terms if t)
    total = sum(len(t) for _, t in terms)
    holding = Counter(w for _, t in terms for w in set(t))
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall((text or "").translate(LOWER))), []
        for doc, t in terms:
            tf = Counter(t)
            m = 100 - 25 + (25 * len(t) * n) // total if total else 0
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * holding[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 12 * m))
                for w, r in asked.items()
                if tf[w]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return out


@pytest.mark.parametrize("block_bytes, batch", [(10**6, 10_000), (400, 7)])
def test_search_equals_brute_force(spark, make, block_bytes, batch):
    rng = random.Random(3)
    book = [prose(i, 1) + str(i % 40) for i in range(300)]
    data = [(i, " ".join(rng.choices(book, k=rng.randint(0, 80)))) for i in range(120)]
    data += [(7, "Same, id! same-ID"), (None, book[0] + " " + book[1]), (130, None), (131, "..."), (132, data[5][1]), (133, data[5][1])]
    items = [(i, " ".join(rng.choices(book, k=rng.choice([1, 5, 40, 150])))) for i in range(15)]
    items += [(20, None), (21, "?!"), (22, "unheard-of words"), (23, "SAME id"), (23, book[3]), (None, book[4])]
    asked = spark.createDataFrame(items, "item_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = ranked_search.search(make(data), asked, block_bytes=block_bytes)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        found = Counter(tuple(r) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == Counter(slow_search(data, items))


def test_search_of_odd_and_empty_tables(spark, odd, nothing):
    items = [(1, "x no id"), (2, "nul BYTE endoftext 123"), (3, prose(1, 50))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    data = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(tuple(r) for r in ranked_search.search(odd, asked).collect()) == Counter(slow_search(data, items))
    assert rows(ranked_search.search(nothing, asked)) == [] and rows(ranked_search.search(odd, asked.limit(0))) == []


def test_search_with_ids_as_text(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "three")], "name string, body string")
    got = ranked_search.search(docs, spark.createDataFrame([(1, "two")], "item_id long, text string"), 1, "name", "body")
    assert [(r["rank"], r["name"]) for r in got.collect()] == [(1, "a")]
