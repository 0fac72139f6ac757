"""The mix on rows with null and repeated ids."""

from collections import Counter

from pyspark.sql import functions as F

from test_texts import WORD
from tilewright.llm.mixing import mix, take


def test_take_gives_what_mix_states(spark):
    text = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    rows = [(None, text(k, 20 + k % 5), "a") for k in range(60)] + [(1, text(0, 37), "b")] * 30 + [(k % 3, text(k, 50), "c") for k in range(40)]
    rows += [(5, text(5, 11), None)] * 7 + [(None, text(6, 13), None)] * 9 + [(None, None, "a"), (None, "", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text")).repartition(4)
    for share, epochs in ((1.5, 2), (0.3, 2), (0.71, 1), (2.9, 4)):
        want, got = Counter(), Counter()
        for r in mix(docs, share, epochs).collect():
            want[r.source, r.doc_id] += r.taken
        out = take(docs, share, epochs).collect()
        for r in out:
            got[r.source, r.doc_id] += len(WORD.findall(r.text or ""))
        assert +got == +want
        assert sum(not r.text for r in out) == 2 and all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)
