"""Fingerprints against loops that share nothing with the operator but its stated parameters."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tabsift.llm import digest
from tabsift.llm.digest import CAPACITY, CHANCE, FILTER_BITS, HASHES, LEVELS, LOWEST, POPULAR, RUN, WINDOW

from .conftest import prose

WORD = (1 << 64) - 1


def plain_level(window):
    share = [0, *(round(c * math.log2(c) * (1 << 16)) for c in range(1, WINDOW + 1))]
    return (share[WINDOW] - sum(share[c] for c in Counter(window).values())) * (LEVELS - 1) // share[WINDOW]


def plain_hash(window):
    h = 0x9E3779B97F4A7C15
    for at in range(0, WINDOW, 8):
        h = ((h ^ int.from_bytes(window[at : at + 8], "little")) * 0xBF58476D1CE4E5B9) & WORD
        h ^= h >> 29
    h = (h * 0x94D049BB133111EB) & WORD
    return h ^ (h >> 32)


def plain_chain(text, rank, whole=True):
    """Sets of bit numbers, a set per filter, in text order; a ``whole`` text has a feature however little its entropy."""
    raw = (text or "").encode()
    if not raw:
        return []
    windows = [raw[i : i + WINDOW] for i in range(len(raw) - WINDOW + 1)]
    if not windows:
        features = [int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")]
    else:
        level, points = [plain_level(w) for w in windows], Counter()
        for start in range(1 - RUN, len(windows)):
            points[min(range(max(start, 0), min(start + RUN, len(windows))), key=lambda i: (rank[level[i]], i))] += 1
        places = [i for i in range(len(windows)) if points[i] >= POPULAR and level[i] >= LOWEST]
        if not places and whole:
            places = [min(range(len(windows)), key=lambda i: (rank[level[i]], i))]
        features = [plain_hash(windows[i]) for i in places]
    distinct = list(dict.fromkeys(features))
    parts = [distinct[i : i + CAPACITY] for i in range(0, len(distinct), CAPACITY)]
    return [{(h >> (11 * j)) % FILTER_BITS for h in part for j in range(HASHES)} for part in parts]


def plain_text(chain):
    """Filters as bytes, highest bit first."""
    return base64.b64encode(b"".join(sum(1 << (FILTER_BITS - 1 - b) for b in bits).to_bytes(FILTER_BITS // 8, "big") for bits in chain)).decode()


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = sorted((a, b), key=lambda c: (len(c), base64.b64decode(plain_text(c))))
    total = 0.0
    for mine in a:
        best = 0.0
        for other in b:
            most, expected = min(len(mine), len(other)), len(mine) * len(other) / FILTER_BITS
            floor = expected + CHANCE * (most - expected)
            best = max(best, min(1.0, max(0.0, (len(mine & other) - floor) / max(most - floor, 1e-9))))
        total += len(mine) * best
    return total / sum(map(len, a))


TEXTS = ["", None, "short", "x" * 400, prose(1, 40), prose(1, 40), prose(1, 39) + " other end", prose(2, 900), prose(2, 880) + prose(3, 300), prose(4, 2500), "ö" * 7 + prose(5, 60)]


@pytest.fixture(scope="module")
def rank():
    return np.array(random.Random(8).sample(range(LEVELS), LEVELS))


def test_chains_and_likeness(rank):
    plain = [plain_chain(t, rank, whole=False) for t in TEXTS]
    chains = []
    for t in TEXTS:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        places = digest.chosen(digest.levels(raw), rank) if len(raw) >= WINDOW else np.zeros(0, int)
        chains.append(digest.filters(digest.hashed(raw, places) if len(raw) else np.zeros(0, np.uint64)))
    assert [digest.text_of(c) for c in chains] == [plain_text(p) for p in plain]
    assert max(map(len, plain)) > 2
    for a, p in zip(chains, plain, strict=True):
        for b, q in zip(chains, plain, strict=True):
            assert digest.likeness(a, b) == pytest.approx(plain_likeness(p, q), abs=1e-12)


def test_compared_documents(make, rank):
    """The edited text and the next document, both ways round the table."""
    got = digest.compared(make(list(enumerate(TEXTS))), rank).collect()
    texts = [t or "" for t in TEXTS]
    for r in sorted(got, key=lambda r: r.doc_id):
        t, after = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, changed, following = (plain_chain(x, rank) for x in (t, edited, after))
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (plain_text(own), plain_text(changed))
        assert r.near_edited == pytest.approx(plain_likeness(own, changed), abs=1e-9)
        assert r.near_next == pytest.approx(plain_likeness(own, following), abs=1e-9)
