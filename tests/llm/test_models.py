"""Scores on held-out rows, packing round trips, URL rules, vectors and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import awkward
from tilewright.llm import packing as P
from tilewright.llm.common import held_out, table
from tilewright.llm.cutting import best_pattern, plan
from tilewright.llm.mixing import take
from tilewright.llm.neardup import near_duplicates
from tilewright.llm.quality import isotonic, score_quality
from tilewright.llm.secrets import redact
from tilewright.llm.toxicity import score_toxicity
from tilewright.llm.urls import PATTERNS, SITE_RULES, filter_urls, index, parse
from tilewright.llm.vectors import near_vectors

SF = "/root/testdata/sf0.01"


def test_held_out_follows_crc32(spark):
    got = {r.i: r.h for r in spark.range(50).select(F.col("id").alias("i"), held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}


@pytest.mark.parametrize("score,label,threshold", [(score_toxicity, "toxic", 0.7), (score_quality, "quality", 0.5)])
def test_scores_on_held_out_rows(spark, score, label, threshold):
    labels = table(spark, SF, "labels")
    out = score(table(spark, SF, "documents"), labels).toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all() and ((out.score >= threshold) == (out.predicted == 1)).all()
    held = labels.where(held_out(F.col("doc_id"))).toPandas().merge(out, on="doc_id")
    good, bad = held[held[label] == 1].score.to_numpy(), held[held[label] == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2 > 0.85
    # held-out labels are not read: turning them changes nothing
    turned = labels.withColumn(label, F.when(held_out(F.col("doc_id")), 1 - F.col(label)).otherwise(F.col(label)))
    again = score(table(spark, SF, "documents"), turned).toPandas().set_index("doc_id").score
    assert np.allclose(again.loc[out.doc_id].to_numpy(), out.score.to_numpy())


@pytest.mark.parametrize("score,label", [(score_toxicity, "toxic"), (score_quality, "quality")])
def test_scores_of_awkward_tables(spark, score, label):
    docs = awkward.documents(spark)
    some = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)] + [(None, 1), (3, None), (4, 0), (4, 1)], f"doc_id long, {label} int")
    assert Counter(r.doc_id for r in score(docs, some).collect()) == Counter(i for i, _ in awkward.rows())
    one = score(docs, some.where(f"{label} = 1")).select("score").distinct().collect()
    none = score(docs, some.limit(0)).select("score").distinct().collect()
    assert [r.score for r in one] == [1.0] and len(none) == 1
    assert score(awkward.empty(spark), some).count() == 0


def test_isotonic_is_rising_and_keeps_the_mean():
    points = [(k / 10, float(k in (3, 5, 6, 8, 9)), 1.0) for k in range(10)]
    x, y = isotonic(points)
    assert (np.diff(y) > 0).all() and (np.diff(x) > 0).all() and np.interp(0.0, x, y) == 0


def test_best_pattern_is_the_best():
    rng = random.Random(4)
    for _ in range(30):
        size = 12
        value = np.array([0.0] + [rng.choice((0, 0, rng.random())) for _ in range(size)])
        top = [0.0] * (size + 1)
        for c in range(1, size + 1):
            top[c] = max([top[c - 1]] + [value[k] + top[c - k] for k in range(1, c + 1)])
        total, counts = best_pattern(value, size)
        assert total == pytest.approx(top[size]) and counts @ value == pytest.approx(total) and counts @ np.arange(size + 1) <= size


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_plan_places_every_piece_once(n):
    rng = np.random.default_rng(n)
    demand = np.bincount(rng.integers(1, 65, n), minlength=65)
    fill, seen = defaultdict(list), Counter()
    for length, lo, hi, share, first, offset in plan(demand, 64):
        for r in range(lo, hi):
            seen[length, r] += 1
            fill[first + (r - lo) // share].append((offset + (r - lo) % share * length, length))
    assert set(seen.values()) <= {1} and Counter(k for k, _ in seen) == Counter({k: int(c) for k, c in enumerate(demand) if c})
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_both_encoders_agree():
    json_path, ranks = P.vocabulary_path("byte_bpe_50k.json"), P.vocabulary_path("byte_bpe_50k.tiktoken")
    texts = ["", None, " ", "a\n\n  b", "naïve 한글 ١٢٣ x²", "<|endoftext|> x", "I'll 'S", "\x00\x1c d", "é" * 500, awkward.LONG, *(t for _, t in awkward.rows())]
    for t in texts:
        assert (P.token_ids(t, json_path, None) == P.token_ids(t, json_path, ranks)).all()


def test_packing_round_trip(spark):
    out = P.pack(awkward.documents(spark), with_ids=True).toPandas()
    json_path = P.vocabulary_path("byte_bpe_50k.json")
    want = Counter((i, tuple(P.token_ids(t, json_path, None).tolist())) for i, t in awkward.rows() if i not in (None, 7))
    got = Counter()
    for i, part in out[out.doc_id.notna() & (out.doc_id != 7)].groupby("doc_id"):
        part = part.sort_values("start")
        got[int(i), tuple(x for ids in part.ids for x in ids)] += 1
        assert (part.doc_tokens == part.length.sum()).all()
    assert got == want
    assert (out.ids_crc32 == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in out.ids]).all()
    for _, seq in out.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq.offset == seq.length.cumsum() - seq.length).all() and seq.length.sum() <= 1024
    assert P.pack(awkward.empty(spark)).count() == 0


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = ""
    while len(host) < len(rest) and rest[len(host)] not in "/?#":
        host += rest[len(host)]
    path = rest[len(host):].split("?")[0].split("#")[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in SITE_RULES if (low == h or low.endswith("." + h)) and path.startswith(p)]
    return low, path, *(max(fits)[1:] if fits else (None, None))


URLS = ["http://WWW.Example.com/en/x?y#z", "https://example.com/en/", "example.com/en/", "https://a.example.com/en", "http://com", "http://x.com?/en/", None, "",
        "http://a.net/es/1", "http://a.net/ES/1", "http://net/fr/", "http://casino.example.org/x", "http://mycasino.org/", "http://poker-x.org:80/a", "http://big-win.org/",
        "http://x.org/a.exe?x=1", "http://x.org/a.executable", "https://archive.org/login/", "https://x.org/login/", "https://x.org/login", "ftp://x.org/robots.txt?gclid=1",
        "http://pornotube.org/", "x?gclid=2", "http://é.org/es/", "http://a.org/b://c.net/es/", "http://viagraz.x.org/", "http://x.org/\nlogin/"]


def test_url_rules_match_trying_every_pattern(spark):
    pages = spark.createDataFrame([*enumerate(URLS), (None, "http://a.net/fr/"), (3, URLS[3])], "page_id long, url string").withColumn("host", F.lit("x"))
    import re
    parsed = sorted(map(parse, PATTERNS), key=lambda p: not p.allows)
    for r in filter_urls(pages).join(pages.select("page_id", "url").distinct(), "page_id").collect():
        host, path, rule, verdict = plain_url(r.url)
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.url or "")
        hit = next((p for p in parsed if re.search(p.regex, low)), None) if rule is None else None
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert (r.verdict, r.pattern) == (verdict or ("block" if hit and not hit.allows else "allow"), hit and hit.text), r
    assert filter_urls(pages).count() == len(URLS) + 2 and filter_urls(pages.limit(0)).count() == 0


def test_patterns_are_indexed_by_their_rarest_word():
    rules = [parse(p) for p in ("||ads.", "/free-download/", "||porn", "||*x-y^")]
    assert [p.tokens for p in rules] == [("ads",), ("download", "free"), (), ("y",)]
    assert index(rules, {"free": 5, "download": 2}) == ({"ads": [0], "download": [1], "y": [3]}, [2])


def test_vectors_match_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 32))
    rows = [(k, (centres[k % 12] + rng.normal(size=32) * (0.02 if k % 3 else 0.2)).tolist(), k % 2) for k in range(400)]
    rows += [(1000 + k, rows[0][1], 0) for k in range(40)] + [(2000, [2 * x for x in rows[1][1]], 1), (2001, None, 0), (2002, [0.0] * 32, 0), (2003, [float("nan")] * 32, 0),
             (2004, [None] * 32, 0), (2005, rows[0][1], None), (2006, [], 0), (2007, [1.0, 2.0], 0), (2008, [2.0, 4.0], 0), (2009, [1e300] * 32, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rank", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(frame).collect()}
    usable = {i: (np.array(v, float) / max(map(abs, v)), y) for i, v, y in rows if y is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in usable for b in usable if a < b and usable[a][1] == usable[b][1] and len(usable[a][0]) == len(usable[b][0])
             and usable[a][0] @ usable[b][0] / np.linalg.norm(usable[a][0]) / np.linalg.norm(usable[b][0]) >= 0.98]
    from test_texts import roots
    root, degree = roots(links, [r[0] for r in rows]), Counter(x for e in links for x in e)
    want = {i: (degree[i], root[i], root[i] == i) for i, _, _ in rows}
    assert got == want and len(links) > 1000
    assert near_vectors(frame.limit(0)).count() == 0


def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline as C

    docs = table(spark, SF, "documents").limit(300).cache()
    stage = dict(C.STAGES)
    kept = stage["toxicity"](spark, docs, SF)
    bad = {r.doc_id for r in score_toxicity(docs, table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert bad and kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad
    single = stage["near-duplicates"](spark, docs, SF)
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in near_duplicates(docs).collect()}
    masked = stage["secrets"](spark, docs, SF)
    assert {r.doc_id: r.text for r in masked.collect()} == {r.doc_id: redact(r.text) for r in docs.collect()}
    mixed = stage["mixing"](spark, docs, SF)
    assert mixed.columns == docs.columns and sorted(map(str, mixed.collect())) == sorted(map(str, take(docs).collect()))
    packed = stage["packing"](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
