"""Toxicity of texts: gradient-boosted trees over lexicon and style features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import cut, labelled, per_row

# Insults that count in any corpus, and second-person words of the four languages.
INSULTS = ("asshole bastard bitch clown cretin disgusting dumb fool freak fuck garbage idiot imbecile jerk kill loser lunatic moron "
           "pathetic pig retard scum shit slut stupid trash vermin whore worthless "
           "abschaum arschloch dummkopf idiotin miststück scheisse trottel "
           "connard crétin ordure salaud salope "
           "basura cabrón estúpido imbécil mierda puta").split()
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch tu toi te ton ta tes vous votre vos "
                          "tú ti usted ustedes vosotros".split())
# Signs and digits that stand for letters.
LEET = str.maketrans("013457@$!", "oieastasi")
STEMS = (3, 4, 5, 6)
NEAR = 5
_WORD = re.compile(r"\w+")
_MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]+[0-9@$!*]+[^\W\d_][\w@$!*]*")
_SPELLED = re.compile(r"\b(?:\w[ .\-_]){3,}\w\b")
_DRAWN = re.compile(r"(\w)\1{3,}")
_MARKS = re.compile(r"[^\w\s]")
FEATURES = ("lexicon_words", "lexicon_weight", "lexicon_density", "lexicon_distinct", "lexicon_heaviest", "second_person",
            "lexicon_near_second_person", "masked_lexicon", "masked_density", "spelled_out", "drawn_out", "capitals", "capital_words",
            "exclamations", "questions", "marks", "words")


def _weight(word: str, lexicon: dict[str, float]) -> float:
    """Weight of the first form a word has: itself (written =word), or its beginning."""
    for form in ("=" + word, word[:6], word[:5], word[:4], word[:3]):
        if form in lexicon:
            return lexicon[form]
    return 0.0


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Dense features of a whole text; rates are per word or character, so that length alone says little."""
    text = text or ""
    low = text.lower()
    words = _WORD.findall(low)
    n, size = max(1, len(words)), max(1, len(text))
    hits = {i: w for i, w in ((i, _weight(w, lexicon)) for i, w in enumerate(words)) if w}
    you = sum(w in SECOND_PERSON for w in words)
    near = sum(any(w in SECOND_PERSON for w in words[max(0, i - NEAR):i + NEAR + 1]) for i in hits)
    masked = _MASKED.findall(low)
    hidden = sum(_weight(w.translate(LEET).replace("*", ""), lexicon) > 0 for w in masked)
    spelled = _SPELLED.findall(low)
    hidden += sum(_weight(re.sub(r"\W", "", w), lexicon) > 0 for w in spelled)
    capitals = sum(map(str.isupper, _WORD.findall(text))) if low != text else 0
    total = sum(hits.values())
    return [math.log1p(len(hits)), total, 100 * total / n, math.log1p(len({words[i] for i in hits})), max(hits.values(), default=0.0),
            100 * you / n, near / max(1, len(hits)), math.log1p(hidden), 100 * len(masked) / n, math.log1p(len(spelled)),
            100 * len(_DRAWN.findall(low)) / n, sum(map(str.isupper, text)) / size if low != text else 0.0, capitals / n,
            100 * text.count("!") / size, 100 * text.count("?") / size, 100 * len(_MARKS.findall(text)) / size, math.log1p(len(words))]


def learn_lexicon(sample: DataFrame, support: int = 3, candidates: int = 4000, cover: int = 2) -> dict[str, float]:
    """Weighted forms (=word, or the beginning of longer words) that tell label 1 in (doc_id, text, y), and INSULTS.

    A candidate is at least five times as frequent among the words of label 1; the ``candidates`` of largest gain are
    weighed. A greedy cover picks those that explain most documents, each up to ``cover`` times, at the cost of other documents
    that have them; the chance vocabulary of a few copied documents explains nothing more and does not enter. Weights are
    logarithms of the ratio of frequencies. Counts and lists stem from the bounded sample.
    """
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 3)
    forms = lambda w: F.array(F.concat(F.lit("="), w), *(F.when(F.length(w) > k, F.substring(w, 1, k)) for k in STEMS))
    seen = sample.where("text is not null").select("doc_id", "y", F.explode(words).alias("w"))
    tokens = seen.groupBy("w", "y").count().select(F.explode(forms(F.col("w"))).alias("form"), "y", "count").where("form is not null")
    counts = tokens.groupBy("form").agg(F.sum(F.col("y") * F.col("count")).alias("p"), F.sum((1 - F.col("y")) * F.col("count")).alias("n"))
    sizes = {y: (n, d) for y, n, d in seen.groupBy("y").agg(F.count("*"), F.count_distinct("doc_id")).collect()}
    if len(sizes) < 2:
        return {"=" + w: 5.0 for w in INSULTS}
    weight = F.log((F.col("p") + 0.5) / sizes[1][0]) - F.log((F.col("n") + 0.5) / sizes[0][0])
    good = cut(counts.withColumn("weight", weight).where((F.col("p") >= support) & (F.col("weight") >= math.log(5)))
               .orderBy(F.desc(F.col("p") * F.col("weight")), F.desc(F.length("form")), "form").limit(candidates))
    docs = (seen.distinct().select("doc_id", "y", F.explode(forms(F.col("w"))).alias("form")).join(F.broadcast(good.select("form")), "form")
            .distinct().groupBy("form").agg(F.collect_list(F.when(F.col("y") == 1, F.col("doc_id"))).alias("docs"), F.sum(1 - F.col("y")).alias("n")))
    rows, cost = {}, {}
    for form, ids, n in docs.collect():
        rows[form], cost[form] = ids, n
    weights = {form: w for form, w in good.select("form", "weight").collect()}
    price = 2 * sizes[1][1] / sizes[0][1]
    need = dict.fromkeys({d for ids in rows.values() for d in ids}, cover)
    lexicon = {"=" + w: max(3.0, weights.get("=" + w, 5.0)) for w in INSULTS}
    for form in lexicon:
        for d in rows.pop(form, ()):
            need[d] -= 1
    gain = {f: sum(need[d] > 0 for d in ids) - price * cost[f] for f, ids in rows.items()}
    while gain:
        form = max(gain, key=lambda f: (gain[f], len(f), f))
        now = sum(need[d] > 0 for d in rows[form]) - price * cost[form]
        if now < gain[form]:  # gains only fall; look again in its turn
            gain[form] = now
            continue
        if now < support:
            break
        if not any(form.startswith(f) or f.startswith(form) for f in lexicon):  # else it explains the same words again
            lexicon[form] = weights[form]
            for d in rows[form]:
                need[d] -= 1
        del gain[form]
    return lexicon


def _described(docs: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    def run(text, *kept):
        return [(*kept, features(text, lexicon))]

    kinds = dict(docs.dtypes)
    return per_row(docs, run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", features array<double>", ["text", *keep])


def training_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, y, part) of at most ``rows`` labelled documents not held out, chosen by a hash; a quarter of them calibrates."""
    chosen = labelled(labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) == 0
    return cut(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y", part.alias("calibrates")))


def score_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = 12_000, trees: int = 20,
                   threshold: float = 0.7, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc_id (or the columns ``keep``), score, predicted for each row of (doc_id, text), from (doc_id, label) rows that are not held out.

    Lexicon and trees are fitted on at most ``sample_rows`` labelled documents; everything is scored by whole text.

    Null and empty texts have the features of an empty text and are scored like any other. Null labels and ids are not
    learned from; an id with both labels counts as 1; repeated rows are scored each. With no labels every score is 0, with
    labels of one kind that kind's share. An empty table gives no rows; other columns than ``keep`` are ignored.
    """
    sample = training_sample(documents, labels, label, sample_rows)
    fit, rest = sample.where("not calibrates"), sample.where("calibrates")
    kinds = {(y, c) for y, c in sample.groupBy("y", "calibrates").count().select("y", "calibrates").collect()}
    docs = documents.withColumn("doc_id", F.col("doc_id").cast("long")).select("text", *keep)
    if len({y for y, c in kinds if not c}) < 2:
        score = F.lit(float(max((y for y, _ in kinds), default=0)))
        return docs.select(*keep, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
    if len({y for y, c in kinds if c}) < 2:
        rest = sample
    lexicon = learn_lexicon(fit)
    vector = array_to_vector("features")
    known = cut(_described(sample, lexicon, ["doc_id", "y", "calibrates"]))
    as_rows = lambda df: df.select(vector.alias("x"), F.col("y").cast("double").alias("y"), "calibrates")
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=trees, maxDepth=3, stepSize=0.2, seed=1, cacheNodeIds=False,
                          checkpointInterval=-1).fit(as_rows(known.where("not calibrates")))
    margin = lambda df: model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])
    held = as_rows(known.where("calibrates") if rest is not sample else known)
    curve = IsotonicRegression(featuresCol="margin", labelCol="y", predictionCol="score").fit(margin(held).select("margin", "y"))
    scored = curve.transform(margin(_described(docs, lexicon, list(keep)).select(*keep, vector.alias("x"))))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score"))
    return scored.select(*keep, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
