"""Small tables with nulls, empty and long texts, ties, repeated rows and columns whose names operators use inside."""

from __future__ import annotations

import random

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, rank long, shard long, key long, id long, "
          "rep long, features string, words string, root long, label string, score double, y int")


def rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    syllables = "an ber ción der el fa gre hu is jo ka lo mi né or pü".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    base = [[word() for _ in range(rng.choice((3, 5, 30, 80, 200)))] for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base[:25]:  # copies with a few words changed, from most alike to hardly alike
        for k in (1, 2, 4, 9):
            c = list(b)
            for _ in range(k):
                c[rng.randrange(len(c))] = word()
            texts.append(rng.choice((" ", "\n", "\t  ")).join(c))
    texts += [t.upper() for t in texts[:5]] + [texts[0], texts[0], None, None, "", " \n\t ", LONG, LONG + " end", "a b c", "A  b c", "é" * 40]
    return [(k, t) for k, t in enumerate(texts)] + [(None, texts[1]), (None, None), (7, texts[7]), (7, texts[7])]


def documents(spark, extra: bool = True):
    data = [(i, t, None if i is None else "en", None if i is None or i % 11 == 0 else f"s{min(i % 7, 3)}", None if t is None else len(t))
            + (9,) * 6 + ("x", "y", 1, "z", 0.5, 1) for i, t in rows()]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty(spark):
    return documents(spark).limit(0)
