"""Quality rules under weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import BLANK, cut

WINDOW = 8
ROUNDS = 20
PRIOR = 0.85
# Prior accuracy of a rule on good documents, for those that look for a plain fault and for those that only give a hint (WEAK), and on
# bad ones: a rule that looks for one fault says good of bad documents with another.
GOOD, GOOD_WEAK, BAD = 0.995, 0.9, 0.5
WEAK = ("variety", "length", "long_lines", "few_kinds")
# What the priors weigh, as a share of all documents, so that tables of any size are judged alike. Faults are of several kinds that seldom
# meet in one document; without priors the commonest kind becomes all that "bad" means and the others pass as noise.
STRENGTH = 0.1


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{BLANK}]+"), lambda w: w != "")


def _repeated_words() -> Column:
    """Words in windows of WINDOW found twice or more in ``words``.

    Windows are compared by a 64-bit hash. Only where hashes repeat are they sorted with their places; neighbours of equal hash
    give the places, in order, and each covers the words up to the next place or its own end.
    """
    windows = F.col("windows")
    n = F.size(windows)
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda p, q: F.coalesce(p["h"] == q["h"], F.lit(False))
    twice = F.filter(F.zip_with(pairs, F.zip_with(
        F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(pairs, 1, n - 1)), F.concat(F.slice(pairs, 2, n), F.array(F.lit(None).cast("struct<h:bigint,i:int>"))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p, ab: F.when(same(p, ab["a"]) | same(p, ab["b"]), p["i"])), lambda i: i.isNotNull())
    places = F.array_sort(twice)
    covered = F.aggregate(places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")), lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n"), i.alias("last")))["n"]
    return F.when(F.size(F.array_distinct(windows)) < n, covered).otherwise(F.lit(0).cast("long"))


def measures(documents: DataFrame) -> DataFrame:
    """doc_id and what the rules look at, for each row of (doc_id, text); a null text counts as empty."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", _words(F.col("text"))).withColumn("lines", F.filter(
        F.split("text", "\n"), lambda line: line.rlike(f"[^{BLANK}]")))
    rows = rows.withColumn("windows", F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("long")
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(F.regexp_replace("text", f"[{BLANK}]+", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words().alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"), F.size(F.array_distinct("words")).cast("long").alias("n_kinds"),
        count("[A-Z]").alias("n_capitals"), count("!").alias("n_shouts"))


def votes() -> dict[str, Column]:
    """Each rule's vote on the measures: 1 for good, -1 for bad, 0 to abstain."""
    def rule(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    words, chars, lines = (F.greatest(c, F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    mean = F.col("word_chars") / words
    return {
        "symbols": rule(F.col("n_symbols") > 0.1 * words, F.col("n_symbols") < 0.02 * words),
        "symbol_characters": rule(F.col("n_symbols") > 0.05 * chars, F.col("n_symbols") == 0),
        "word_length": rule((mean < 2) | (mean > 12), (mean > 3) & (mean < 9)),
        "capitals": rule(F.col("n_capitals") > 0.4 * chars, F.col("n_capitals") < 0.15 * chars),
        "shouting": rule(F.col("n_shouts") > 0.2 * words, F.col("n_shouts") < 0.02 * words),
        "repeated_words": rule(F.col("n_repeat_words") > 0.3 * words, F.col("n_repeat_words") == 0),
        "repeated_lines": rule((F.col("n_lines") >= 5) & (F.col("n_dup_lines") > 0.6 * F.col("n_lines")), F.col("n_dup_lines") == 0),
        "variety": rule((F.col("n_words") >= 50) & (F.col("n_kinds") < 0.2 * words), (F.col("n_kinds") > 0.3 * words)),
        "length": rule(F.col("n_words") < 60, F.col("n_words") >= 120),
        "long_lines": rule(words > 100 * lines, words <= 60 * lines),
        "few_kinds": rule((F.col("n_words") >= 50) & (F.col("n_kinds") < 0.55 * words), F.col("n_kinds") > 0.7 * words),
    }


def priors(names: list[str]) -> list[tuple[float, float]]:
    """Prior accuracy of each rule on good and on bad documents."""
    return [(GOOD_WEAK if name in WEAK else GOOD, BAD) for name in names]


def _learn(prior: list[tuple[float, float]]) -> Column:
    """Expectation-maximisation in one row: share of good documents and accuracies from the array ``patterns`` of (v, n).

    A vote pattern occurs n times; there are at most 3 ** rules of them, whatever the number of documents. A rule has one accuracy
    on good and one on bad documents. Each estimate is that of the votes, weighed by the posterior, with the prior as further votes.
    """
    rules = len(prior)

    def step(state: Column) -> Column:
        judged = F.transform("patterns", lambda p: F.struct(p["v"].alias("v"), p["n"].alias("n"), posterior(p["v"], state).alias("q")))
        total = F.aggregate(judged, F.lit(0.0), lambda a, p: a + p["n"])
        good = F.aggregate(judged, F.lit(0.0), lambda a, p: a + p["n"] * p["q"])

        def rule(j: Column) -> Column:
            more_good, more_bad = STRENGTH * PRIOR * total, STRENGTH * (1 - PRIOR) * total
            zero = F.struct(*(F.lit(0.0).alias(k) for k in ("gr", "gw", "br", "bw")))
            add = lambda a, p, k, vote, q: (a[k] + F.when(p["v"][j] == vote, p["n"] * q).otherwise(0.0)).alias(k)
            fit = lambda right, wrong, more, k: (right + more * F.element_at(before, j + 1)[k]) / (right + wrong + more)
            return F.aggregate(judged, zero, lambda a, p: F.struct(add(a, p, "gr", 1, p["q"]), add(a, p, "gw", -1, p["q"]),
                                                                  add(a, p, "br", -1, 1 - p["q"]), add(a, p, "bw", 1, 1 - p["q"])),
                               lambda a: F.struct(fit(a["gr"], a["gw"], more_good, "g").alias("g"), fit(a["br"], a["bw"], more_bad, "b").alias("b")))

        fitted = F.transform(F.sequence(F.lit(0), F.lit(rules - 1)), rule)
        return F.struct(((good + STRENGTH * PRIOR * total) / ((1 + STRENGTH) * total)).alias("prior"), fitted.alias("rules"))

    before = F.array(*(F.struct(F.lit(g).alias("g"), F.lit(b).alias("b")) for g, b in prior))
    start = F.struct(F.lit(PRIOR).alias("prior"), before.alias("rules"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda state, _: step(state))


def posterior(v: Column, state: Column) -> Column:
    """Probability of good: the prior's log odds and, for each vote cast, the log ratio of its probabilities for good and bad."""
    said = F.zip_with(v, state["rules"], lambda x, r: F.when(x == 1, F.log(r["g"] / (1 - r["b"]))).when(x == -1, F.log((1 - r["g"]) / r["b"])).otherwise(0.0))
    return 1 / (1 + F.exp(-F.aggregate(said, F.log(state["prior"] / (1 - state["prior"])), lambda s, x: s + x)))


def judge_quality(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the measures, base_failed, quality (posterior probability) and kept for each row of (doc_id, text).

    Rules are weighed over all documents: votes are counted by pattern before anything is learned. Documents without enough words
    or mostly repetition fail regardless; the others are kept at a posterior of ``threshold`` or more.

    Null and empty texts fail. Rows are independent given the weights: null or repeated ids are judged like any other. An empty
    table gives no rows.
    """
    rules = votes()
    rows = cut(measures(documents).withColumn("v", F.array(*rules.values())))
    counts = rows.groupBy("v").agg(F.count("*").cast("double").alias("n")).agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("patterns"))
    # the driver sees one row: a prior and two accuracies a rule
    prior, learned = counts.select(F.when(F.size("patterns") > 0, _learn(priors(list(rules)))).alias("state")).select("state.*").first()
    if prior is None:  # no documents
        prior, learned = PRIOR, priors(list(rules))
    state = F.struct(F.lit(prior).alias("prior"), F.array(*(F.struct(F.lit(g).alias("g"), F.lit(b).alias("b")) for g, b in learned)).alias("rules"))
    judged = rows.withColumn("quality", posterior(F.col("v"), state))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         "quality", (~failed & (F.col("quality") >= threshold)).alias("kept"))
