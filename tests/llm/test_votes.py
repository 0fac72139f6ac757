"""Weak supervision against a plain expectation-maximisation, and its verdicts against labels that it never sees."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import awkward
from tilewright.llm import rules as R
from tilewright.llm.common import table


def plain_em(patterns, prior):
    """Share of good documents, accuracies and posterior of each pattern, in plain Python."""
    total, share, state = sum(patterns.values()), R.PRIOR, list(prior)

    def good(v):
        odds = math.log(share / (1 - share))
        for x, (g, b) in zip(v, state):
            odds += math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) if x == -1 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(R.ROUNDS):
        q = {v: good(v) for v in patterns}
        new = []
        for j, (g, b) in enumerate(prior):
            right = sum(n * q[v] for v, n in patterns.items() if v[j] == 1), sum(n * (1 - q[v]) for v, n in patterns.items() if v[j] == -1)
            wrong = sum(n * q[v] for v, n in patterns.items() if v[j] == -1), sum(n * (1 - q[v]) for v, n in patterns.items() if v[j] == 1)
            more = R.STRENGTH * total * R.PRIOR, R.STRENGTH * total * (1 - R.PRIOR)
            new.append(tuple((r + m * p) / (r + w + m) for r, w, m, p in zip(right, wrong, more, (g, b))))
        share, state = (sum(n * q[v] for v, n in patterns.items()) + R.STRENGTH * R.PRIOR * total) / ((1 + R.STRENGTH) * total), new
    return share, state, {v: good(v) for v in patterns}


def check(documents):
    voted = R.measures(documents).withColumn("v", F.array(*R.votes().values()))
    rows = [(r.doc_id, tuple(r.v), r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in voted.collect()]
    share, state, posterior = plain_em(Counter(v for _, v, _ in rows), R.priors(list(R.votes())))
    learned = voted.groupBy("v").agg(F.count("*").cast("double").alias("n")).agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("patterns"))
    got_share, got_state = learned.select(R._learn(R.priors(list(R.votes()))).alias("s")).select("s.*").first()
    assert math.isclose(got_share, share, rel_tol=1e-9)
    assert all(math.isclose(x, y, rel_tol=1e-9) for a, b in zip(got_state, state) for x, y in zip(a, b))
    got = sorted(((r.doc_id, round(r.quality, 9), r.base_failed, r.kept) for r in R.judge_quality(documents).collect()), key=str)
    assert got == sorted(((i, round(posterior[v], 9), f, not f and posterior[v] >= 0.5) for i, v, f in rows), key=str)
    return rows, state, posterior


def test_accuracies_posteriors_and_verdicts_match_plain_em(spark):
    check(awkward.documents(spark))


def test_posterior_replaces_all_must_pass(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows, state, posterior = check(docs)
    lone = [posterior[v] >= 0.5 for _, v, failed in rows if not failed and v.count(-1) == 1]
    assert sum(lone) > 10  # one weak bad vote does not reject a document
    assert all(0.001 < 1 - a and 0.001 < a for pair in state for a in pair[1:])
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").where("quality is not null").collect()}
    judged = [(labels[i], not f and posterior[v] >= 0.5, not f and -1 not in v) for i, v, f in rows if i in labels]
    agree, must_pass = (sum(bool(x[0]) == x[k] for x in judged) / len(judged) for k in (1, 2))
    assert agree > must_pass and agree > 0.95, (agree, must_pass)


def test_clear_faults_are_rejected_without_a_majority(spark):
    plain = [(k, " ".join(f"word{(k * 31 + j * j) % 997}" for j in range(150)) + ".") for k in range(300)]
    noisy = [(1000 + k, " ".join(f"#$%&word{(k * 17 + j * j) % 997}" for j in range(150))) for k in range(20)]
    got = {r.doc_id: r.kept for r in R.judge_quality(spark.createDataFrame(plain + noisy, "doc_id long, text string")).collect()}
    assert all(got[i] for i, _ in plain) and not any(got[i] for i, _ in noisy)
