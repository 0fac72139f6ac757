"""Stages that drop rows, on rows with null and repeated ids, against plain versions."""

from collections import Counter, defaultdict

import awkward
import corpus_pipeline as C
from test_texts import roots, shingles
from tilewright.llm.common import table
from tilewright.llm.toxicity import score_toxicity

SF = "/root/testdata/sf0.01"


def test_toxic_rows_go_whatever_their_id(spark):
    docs = table(spark, SF, "documents").limit(300)
    labels = table(spark, SF, "labels")
    rows = docs.collect()
    bad = {r.doc_id for r in score_toxicity(docs, labels).where("predicted = 1").collect()}
    toxic, clean = [r for r in rows if r.doc_id in bad][:4], [r for r in rows if r.doc_id not in bad][:2]
    extra = [(None, *r[1:]) for r in toxic[:3]] * 2 + [(None, *clean[0][1:]), (toxic[3].doc_id, *clean[1][1:]), (10**9, *toxic[3][1:])]
    more = docs.unionByName(spark.createDataFrame(extra, docs.schema)).cache()
    ids = Counter(r.doc_id for r in more.collect())
    verdict = {r.doc_id: r.predicted for r in score_toxicity(more, labels).collect() if ids[r.doc_id] == 1}
    by_text = {r.text: verdict[r.doc_id] for r in more.collect() if r.doc_id in verdict}
    got = Counter(map(tuple, C.drop_toxic(spark, more, SF).collect()))
    assert got == Counter(tuple(r) for r in more.collect() if not by_text[r.text]) and got[(toxic[3].doc_id, *clean[1][1:])] == 1


def test_one_row_of_each_group_stays(spark):
    rows = awkward.rows()
    only = "these words stand in rows without any id and nowhere else at all"
    rows += [(None, only)] * 3 + [(None, only.upper()), (9, "another text under nine that is like no other text here"), (9, rows[2][1])] + [(500, rows[4][1])] * 2
    rows += [(None, None), (600, ""), (600, "")]
    texts = sorted({t for _, t in rows if shingles(t)})
    sets = [shingles(t) for t in texts]
    links = [(a, b) for b in range(len(texts)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = roots(links, range(len(texts)))
    root = {t: root[k] for k, t in enumerate(texts)}
    groups = defaultdict(list)
    for i, t in rows:
        groups[root.get(t)].append((i is None, i))
    blank = groups.pop(None)
    want = Counter((g, min(ids)[1]) for g, ids in groups.items())
    frame = spark.createDataFrame([(i, t, "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string, n_chars int").repartition(3)
    kept = C.drop_near_duplicates(spark, frame, SF)
    got = kept.collect()
    assert kept.columns == frame.columns and set(got) <= set(frame.collect())
    assert Counter((root[r.text], r.doc_id) for r in got if r.text in root) == want
    assert sum(r.text not in root for r in got) == len(blank) and len(got) == len(want) + len(blank)
    assert set(got) == set(C.drop_near_duplicates(spark, frame.repartition(5), SF).collect())
    assert C.drop_near_duplicates(spark, frame.limit(0), SF).count() == 0
