"""Near duplicates, secrets, quality rules, licences and mixing against plain versions."""

import hashlib
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import awkward
from tilewright.llm import secrets as S
from tilewright.llm.components import components
from tilewright.llm.licenses import SENTENCES, scan_licenses
from tilewright.llm.mixing import mix, source_targets, take
from tilewright.llm.neardup import near_duplicates
from tilewright.llm.rules import judge_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i:i + 5]) for i in range(len(w) - 4)))


def roots(links, nodes):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, k) for k in range(6, 60)] + [(200, 201), (201, 202), (202, 200), (3, 3), (60, 5), (60, 140)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links + [(None, 4)], "u long, v long")).collect()}
    want = roots([e for e in links if e[0] != e[1]], {n for e in links for n in e if e[0] != e[1]})
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def near_expected(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return roots(links, ids)


def test_near_duplicates_match_all_pairs(spark):
    rows = awkward.rows()
    out = near_duplicates(awkward.documents(spark)).collect()
    want = near_expected(rows)
    assert len(out) == len(rows)
    sizes = Counter((i, len(shingles(t))) for i, t in rows)
    assert Counter((r.doc_id, r.n_shingles) for r in out) == sizes
    assert {(r.doc_id, r.component_id) for r in out if r.doc_id is not None} == set(want.items())
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert len(set(want.values())) < len(want)
    assert near_duplicates(awkward.empty(spark)).count() == 0


def test_near_copies_of_one_text_that_do_not_all_link(spark):
    """Many edited copies of one text: some link with each other only, so leaders alone do not find all components."""
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(90):
        c = list(base)
        for j in range(1 + k % 7):
            c[(k * 17 + j * 23) % 150] = f"n{k}_{j}"
        rows.append((k, " ".join(c)))
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == near_expected(rows)


def plain_spans(text):
    found = []
    for kind, pattern in (("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
                          ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")):
        for m in re.finditer(pattern, text or ""):
            if kind == "assign" and len(m[2]) >= 6 or kind == "access" and len(m[0]) >= 20 or kind == "hex" and len(m[0]) >= 24:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], S.BASE.index(s[0])))


def signed(prefix, body):
    return f"{prefix}_{body}{S._base62(zlib.crc32(body.encode()), 6)}"


SECRETS = ["password=abcdef", "password = 'x' token: \"abcdef12\"", "tokentoken=abcdefg", "pässwörd token=secret=abcdefgh é" + "a1" * 13,
           "password: token: abcdef", "API_KEY:  \"zzzzzzzz\" apikey==abc=def", "AKIAAKIA" + "A" * 16, "akia" + "A" * 20, "AKIA" + "0" * 16 + "é",
           "f" * 24, "g" + "0" * 23 + "g" + "1" * 25, "ToKen=abcdefg ſecret=abcdefg", "secret\n=abcdef", None, "", "token=abcde",
           "x" * 5000 + "token=" + "ab" * 20, "ü" * 300 + "secret:'" + "9" * 30]


def test_secrets_match_plain_search_and_checksums(spark):
    for text in SECRETS:
        assert [s for s in S.find_spans(text) if s[0] in S.BASE] == plain_spans(text), text
    good, bad = signed("ghp", "a1B2c3D4e5" * 3), signed("ghp", "a1B2c3D4e5" * 3)[:-1] + "!"
    assert [s[0] for s in S.find_spans(f"x {good} y")] == ["signed_token"]
    assert S.find_spans(f"x {bad} y") == []
    assert S.redact(f"é {good} y token=abcdefgh") == "é [secret] y [secret]"
    assert S.redact("nothing here") == "nothing here" and S.redact(None) is None
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SECRETS)] + awkward.rows(), "doc_id long, text string").withColumn("spans", F.lit(1))
    got = Counter(tuple(r) for r in S.scan_secrets(docs).collect())
    want = Counter()
    for i, t in [*enumerate(SECRETS), *awkward.rows()]:
        spans = plain_spans(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[(i, *(sum(s[0] == k for s in spans) for k in S.BASE), hashlib.sha256(text.encode()).hexdigest(), text)] += 1
    assert got == want
    assert S.scan_secrets(awkward.empty(spark)).count() == 0
    kept = S.redact_secrets(awkward.documents(spark))
    assert kept.columns == awkward.documents(spark).columns and kept.count() == len(awkward.rows())


def plain_measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_measure_and_judge(spark):
    prose = [(1000 + k, " ".join(f"Word{(k * 31 + i * i) % 997}" for i in range(60)).lower().capitalize() + ".") for k in range(60)]
    junk = [(2000 + k, " ".join(f"w{(k + i * i) % 997}###" for i in range(60))) for k in range(8)]
    shout = [(2100 + k, " ".join(f"WO{(k + i * i) % 997}RD!!" for i in range(60))) for k in range(8)]
    odd = [(3000, "a b c d e f g h a b c d e f g h i"), (3001, "x\ny\nx\n \nx"), (3002, "one two " * 40), (3003, "a|b <c> é#")]
    rows = awkward.rows() + prose + junk + shout + odd
    out = judge_quality(spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("x"))).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out)
    assert got == Counter((i, *plain_measures(t)) for i, t in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.quality <= 1
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[i] for i, _ in prose) and not any(kept[i] for i, _ in junk + shout)
    assert judge_quality(awkward.empty(spark)).count() == 0


def test_licences_are_ordered_rules_over_sentences(spark):
    mit = " ".join(SENTENCES[k] for k in ("mit-grant", "mit-notice", "as-is"))
    wrapped = "// " + "\n// ".join(textwrap.wrap(mit, 70))
    texts = ["Some text.\nReleased under the MIT License.", "# MIT License\n\n" + mit, SENTENCES["mit-notice"] + " " + SENTENCES["mit-grant"],
             "All rights reserved. Licensed under CC BY-NC 4.0.", "x All rights reserved. y", None, "", "licensed under the apache license version 2 0",
             "Hello.\nThis work is licensed under the GNU General Public License, version 3.\nAll rights reserved.\nReleased under the MIT License.", wrapped]
    out = scan_licenses(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("found", F.lit(1)))
    got = {r.doc_id: (r.licenses, r.terms) for r in out.collect()}
    assert got == {0: ("MIT", "permissive"), 1: ("MIT", "permissive"), 2: ("", None), 3: ("CC-BY-NC-4.0,all-rights-reserved", "restricted"), 4: ("", None),
                   5: ("", None), 6: ("", None), 7: ("Apache-2.0", "permissive"), 8: ("MIT,GPL-3.0-only", "copyleft"), 9: ("MIT", "permissive")}
    assert scan_licenses(awkward.documents(spark)).count() == len(awkward.rows())
    assert scan_licenses(awkward.empty(spark)).count() == 0


def plain_targets(sizes, share, epochs):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, left = {}, share * sum(sizes.values())
    free = set(names)
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if total and left * weight[s] / total >= epochs * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
        free -= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1000, "c": 10, None: 400}, {"a": 0, "b": 0}, {"x": 5}, {chr(65 + k): k * k for k in range(20)}])
def test_targets_fill_up_to_caps(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows, 1.5, 2).collect()}
    assert got == pytest.approx(plain_targets(sizes, 1.5, 2))


def test_mix_takes_each_source_to_its_target(spark):
    docs = awkward.documents(spark)
    out = mix(docs).collect()
    by = defaultdict(list)
    for r in out:
        by[r.source].append(r)
    sizes = Counter((i, len(WORD.findall(t or ""))) for i, t in awkward.rows())
    assert Counter((r.doc_id, r.size) for r in out) == sizes
    want = plain_targets({s: sum(r.size for r in v) for s, v in by.items()}, 1.5, 2)
    for s, v in by.items():
        assert v[0].target == pytest.approx(want[s]) and abs(sum(r.taken for r in v) - want[s]) <= 1
        whole = int(want[s] // max(1, v[0].source_size))
        assert all(whole * r.size <= r.taken <= 2 * r.size for r in v)
    assert sorted(map(str, out)) == sorted(map(str, mix(docs.repartition(5)).collect()))
    assert mix(awkward.empty(spark)).count() == 0 and take(awkward.empty(spark)).count() == 0
    mixed = take(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r.source] += len(WORD.findall(r.text or ""))
    # the repeated rows of one document may all be cut alike
    assert all(abs(got[s] - sum(r.taken for r in v)) <= 400 for s, v in by.items())
