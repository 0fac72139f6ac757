"""Ranked search against a plain scorer over all documents and items."""

import math
import re
from collections import Counter

import awkward
from tilewright.llm.lexical import folded, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [(1, "an ber Ción"), (1, "ción an"), (2, None), (3, ""), (4, "--- ?"), (5, "w1 w2 w3 w976 W1"), (None, "é né " + "é" * 40), (6, "nowhereatall"),
         (7, "\x85an fa el w976"), (8, "a a a b"), (9, "grefa fagre jois")]


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked, out = {}, []
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    for item, wanted in asked.items():
        scored = []
        for doc_id, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, k in wanted.items() if c[t])
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def test_ranks_match_a_plain_scorer(spark):
    items = spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, rank int, doc_id string")
    want = expected(awkward.rows(), ITEMS)
    assert {r[0] for r in want} >= {1, 5, None, 7, 8, 9} and len(want) > 30
    docs = awkward.documents(spark)
    for size in (1_000_000, 30):  # in one group, and with several automata
        assert sorted(map(tuple, rank_documents(docs, items, group_bytes=size).collect()), key=str) == want
    assert sorted(map(tuple, rank_documents(docs.repartition(1), items, top=3).collect()), key=str) == expected(awkward.rows(), ITEMS, 3)


def test_no_documents_or_no_items_give_no_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rank_documents(awkward.empty(spark), items).count() == 0
    assert rank_documents(awkward.documents(spark), items.limit(0)).count() == 0
    assert rank_documents(awkward.documents(spark).where("text is null"), items).count() == 0


def test_terms_are_bounded_by_other_ascii_only():
    assert folded("Ab_c É-x\x7fZ") == b" ab c\xc2\xa0\xc3\x89 x z "
    assert folded(None) == b"  "
