"""The whole pipeline against plain Python stages, and the models against plain arithmetic."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as C
from test_texts import WORD, plain_targets, roots, shingles
from tilewright.llm import quality as Q
from tilewright.llm import toxicity as X
from tilewright.llm.common import held_out, table
from tilewright.llm.mixing import SEED
from tilewright.llm.packing import vocabulary_path
from tilewright.llm.secrets import redact

SF = "/root/testdata/sf0.01"


def plain_near(rows):
    texts = sorted({r[1] for r in rows if shingles(r[1])})
    sets = [shingles(t) for t in texts]
    by_shingle = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by_shingle[x].append(k)
    pairs = {(a, b) for ks in by_shingle.values() for i, a in enumerate(ks) for b in ks[i + 1:]}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = dict(zip(texts, (roots(links, range(len(texts)))[k] for k in range(len(texts)))))
    groups = defaultdict(list)
    for r in rows:
        groups[root.get(r[1])].append(r)
    blank = groups.pop(None, [])
    return blank + [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def plain_take(rows, share=1.5, epochs=2):
    size = lambda r: len(WORD.findall(r[1] or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    targets, out = plain_targets(dict(sizes), share, epochs), []
    for source in sizes:
        mine = sorted((r for r in rows if r[3] == source), key=lambda r: (hashlib.md5(f"{SEED}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), size(r)))
        whole = math.floor(targets[source] / sizes[source]) if sizes[source] else 0
        left = int(math.floor(targets[source] + 0.5)) - whole * sizes[source]
        for r in mine:
            n = size(r)
            some = max(0, min(n, left))
            left -= some
            if not n:
                out.append((r[0], r[1]))
            else:
                out += [(r[0], r[1])] * (whole + (some == n))
                if 0 < some < n:
                    out.append((r[0], " ".join(WORD.findall(r[1])[:some])))
    return out


def plain_pieces(docs):
    from tokenizers import Tokenizer

    encoder, out = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")), Counter()
    for doc_id, text in docs:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [0]
        starts, at = [], 0
        while at < len(ids):  # whole sequences, a multiple of 32, the rest
            starts.append(at)
            rest = len(ids) - at
            at += 1024 if rest >= 1024 else rest - rest % 32 if rest >= 32 else rest
        for a, b in zip(starts, [*starts[1:], len(ids)]):
            out[doc_id, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), len(ids)] += 1
    return out


def test_run_equals_plain_stages(spark, tmp_path):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents").limit(260)
    rows = [tuple(r) for r in docs.collect()]
    words = lambda k, n: " ".join(f"own{k}w{j}" for j in range(n))
    extra = [(None, *rows[3][1:]), (None, *rows[3][1:]), rows[4], rows[4], (None, words(1, 31), "en", rows[0][3], 5), (None, words(2, 47), None, None, None),
             (10**8, None, None, rows[0][3], None), (10**8 + 1, "", None, None, 0), (10**8 + 2, "password=abcdef123 " + words(3, 40), None, "elsewhere", None)]
    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes)
    spark.createDataFrame(rows + extra, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    whole = table(spark, str(tmp_path), "documents")
    verdict = {r.copy: r.predicted for r in X.score_toxicity(whole.withColumn("copy", F.col("text")), labels, keep=("copy",)).collect()}
    clean = [r for r in rows + extra if not verdict[r[1]]]
    assert 0 < len(clean) < len(rows + extra)
    single = plain_near(clean)
    assert len(single) < len(clean)
    taken = plain_take([(r[0], redact(r[1]), r[2], r[3]) for r in single])
    got = C.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == plain_pieces(taken)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 1024


def test_stages_need_no_entry_module(spark):
    """STAGES alone send the package to workers."""
    import subprocess
    import sys

    code = """
import sys
sys.path.insert(0, sys.argv[1])
import corpus_pipeline
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
docs = spark.createDataFrame([(1, "token=abcdefgh"), (2, None)], "doc_id long, text string")
print("GOT", [r.text for r in dict(corpus_pipeline.STAGES)["secrets"](spark, docs, "").orderBy("doc_id").collect()])
"""
    import os

    root = os.path.dirname(os.path.abspath(C.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, timeout=300, cwd="/", env=env)
    assert "GOT ['[secret]', None]" in out.stdout, out.stderr[-1500:]


def plain_isotonic(points, at):
    """Greatest lower, least upper mean: the rising step function through weighted points, by its min-max formula."""
    points = sorted(points)
    w, y = np.array([p[2] for p in points]), np.array([p[1] for p in points])
    mean = lambda a, b: y[a:b + 1].sum() / w[a:b + 1].sum()
    fit = [max(min(mean(a, b) for b in range(k, len(points))) for a in range(k + 1)) for k in range(len(points))]
    xs, ys, start = [], [], 0
    for k in range(1, len(points) + 1):
        if k == len(points) or not math.isclose(fit[k], fit[start], abs_tol=1e-12):
            block = slice(start, k)
            xs.append(sum(p[0] * p[2] for p in points[block]) / w[block].sum())
            ys.append(fit[start])
            start = k
    return np.clip(np.interp(at, xs, ys), 0, 1)


def test_quality_scores_equal_a_plain_ridge(spark):
    docs = table(spark, SF, "documents").limit(500).cache()
    labels = table(spark, SF, "labels").where("quality is not null and doc_id is not null")
    got = {r.doc_id: r.score for r in Q.score_quality(docs, labels).collect()}
    stats = {r.doc_id: Q.statistics(r.text) for r in docs.collect()}
    seen = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("y"), F.first(F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) == 0).alias("c"))
    rows = [(np.array(stats[r.doc_id]), r.y, r.c) for r in seen.collect() if r.doc_id in stats]
    x, y = np.array([r[0] for r in rows if not r[2]]), np.array([r[1] for r in rows if not r[2]], float)
    kernel = Q.Kernel(x.mean(0), np.maximum(x.std(0), 1e-6), math.sqrt(Q.STATISTICS), 300)
    z = kernel(x)
    m = z.shape[1]
    # the ridge as least squares over rows that ask for small weights
    more = np.sqrt(np.diag([0.0] + [1.0] * (m - 1)) * 1e-3 * len(x) / m + 1e-9 * len(x) * np.eye(m))
    weights = np.linalg.lstsq(np.vstack([z, more]), np.concatenate([y, np.zeros(m)]), rcond=None)[0]
    bins = defaultdict(lambda: [0.0, 0.0])
    for v, r in zip(kernel(np.array([r[0] for r in rows if r[2]])) @ weights, (r for r in rows if r[2])):
        b = bins[float(np.floor(v * 1000 + 0.5) / 1000)]
        b[0] += r[1]
        b[1] += 1
    ids = sorted(stats)
    want = plain_isotonic([(v, s, w) for v, (s, w) in bins.items()], kernel(np.array([stats[i] for i in ids])) @ weights)
    assert np.abs(np.array([got[i] for i in ids]) - want).max() < 0.02


def test_toxicity_features_of_a_text_counted_by_hand():
    lexicon = {"=fool": 2.0, "idio": 3.0}
    text = "YOU fool! you are an idiot, f00l and i*d*i*o*t. Nobody else? fool"
    f = X.features(text, lexicon)
    words = re.findall(r"\w+", text.lower())
    assert f[16] == math.log1p(len(X._WORD.findall(text.lower()))) and f[13] == 100 / len(text) and f[14] == 100 / len(text)
    assert f[0] == math.log1p(3) and f[1] == 7.0 and f[4] == 3.0 and math.isclose(f[5], 100 * 2 / len(X._WORD.findall(text.lower())))
    assert f[7] >= math.log1p(1) and words[0] == "you"
    assert X.features(None, lexicon) == X.features("", lexicon) and X.features("", lexicon)[0] == 0


def test_more_candidates_change_no_lexicon(spark):
    """The bound on candidate forms stands far behind the forms that the cover takes."""
    sample = X.training_sample(table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels"), "toxic", 12_000)
    assert X.learn_lexicon(sample) == X.learn_lexicon(sample, candidates=40_000)
