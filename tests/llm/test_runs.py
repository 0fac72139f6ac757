"""Periodic runs against all periods of all stretches."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import awkward
from tilewright.llm import runs as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every maximal stretch of each period that is its smallest and long enough."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)  # smaller periods come first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_words(doc_id, text, change):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if not change or doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain(doc_id, text, change):
    words = plain_words(doc_id, text, change)
    found = plain_runs(words) if len(words) < 3000 else None
    if found is None:
        return None
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, found, " ".join(w for i, w in enumerate(words) if i not in dropped))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_and_periodic_texts(seed):
    rng = random.Random(seed)
    for _ in range(120):
        text = []
        while len(text) < rng.choice((1, 7, 30, 150, 400)):
            part = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(rng.choice((1, 2, 3, 5, 8, 13, 40)))]
            text += (part * rng.choice((1, 1, 3, 4, 5, 20)))[:rng.randrange(1, 300)]
        got = [tuple(map(int, r)) for r in zip(*R.find_runs(np.array(text), len(text)))]
        assert got == plain_runs(text), text


def test_runs_of_a_fibonacci_word_and_of_one_symbol():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    for text in (b, [7] * 2000, [1, 2, 3, 4] * 300 + [1, 2], [1, 2, 3, 4, 5, 6, 7] * 3):
        assert [tuple(map(int, r)) for r in zip(*R.find_runs(np.array(text), len(text)))] == plain_runs(text)


def test_wavelet_tree_against_sorting():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 1000):
        values = rng.permutation(n)
        tree = R.WaveletTree(values)
        lo = rng.integers(0, n, 200)
        hi = lo + 1 + (rng.random(200) * (n - lo)).astype(np.int64)
        x = rng.integers(0, n, 200)
        assert tree.smaller(lo, hi, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(lo, hi, x)]
        k = (rng.random(200) * (hi - lo)).astype(np.int64)
        assert tree.kth(lo, hi, k).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(lo, hi, k)]


@pytest.mark.parametrize("change", [None, R.repeat_tail])
def test_documents_match_plain_runs(spark, change):
    got = [tuple(r) for r in R.periodic_runs(awkward.documents(spark), change).collect()]
    want = [plain(i, t, change) for i, t in awkward.rows()]
    known = [w for w in want if w]
    assert len(got) == len(want) and sum(w[1] > 0 for w in known) > (4 if change else -1)
    order = lambda r: (str(r[0]), r[-1])
    got = sorted(((*r[:6], [tuple(x) for x in r[6]], r[7]) for r in got if r[0] in {w[0] for w in known}), key=order)
    assert got == sorted(known, key=order)


def test_a_long_periodic_text(spark):
    words = ["lead"] * 3 + [f"w{i % 977}" for i in range(60_000)] + ["end"]
    got = R.periodic_runs(spark.createDataFrame([(1, "\n".join(words))], "doc_id long, text string")).first()
    assert (got.n_runs, got.start, got.length, got.period, got.exponent_milli) == (1, 3, 60_000, 977, 61_412)
    assert got.collapsed == " ".join(words[:3 + 977] + ["end"])


def test_query_digests_and_empty_tables(spark, tmp_path):
    from tilewright.llm.queries import QUERIES

    awkward.documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    for i, t in awkward.rows()[:150]:
        if w := plain(i, t, True):
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in w[6])
            assert (got[i].runs_sha256, got[i].collapsed_sha256) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (lines, w[7]))
    assert R.periodic_runs(awkward.empty(spark)).count() == 0
