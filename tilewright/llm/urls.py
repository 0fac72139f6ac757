"""URL rules: the longest host and path rule decides, else wildcard patterns that the rarest word of each rule brings up."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import per_row

# Host and path rules, with their verdict.
SITE_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block"))
# Patterns for the rest. * stands for anything, ^ for the end or a character that is not a letter, digit, _ - . or %,
# || for the start of a host label, @@ for an exception, which wins over blocks.
PATTERNS = ("||casino^", "||casino-", "||poker^", "||poker-", "-win.", "||adult.", "||xxx^", "||porn", "||torrent.", "||warez^", "||ads.", "||adserver.",
            "||doubleclick^", "/free-download/", "/cheap-pills/", "?gclid=", "/wp-login.php", "/cgi-bin/", "/login^", "/signup^", "/cart/", "||tracker.",
            ".exe^", ".zip^", ".apk^", "/payday-loans/", "||viagra*.", "||malware.", "||phishing.", "||spam.", "||bet365.", "||lottery^",
            "@@||archive.org^", "@@/robots.txt")
# ASCII lower case only, so that a url keeps its length
_LOW = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Pattern:
    """A wildcard pattern as a regular expression over lower-case urls, and the words every url it matches has whole."""

    text: str
    allows: bool
    regex: str
    tokens: tuple[str, ...]


def parse(text: str) -> Pattern:
    """A word is sure to be whole in the url if both its neighbours in the pattern are signs, not ends or wildcards."""
    body = text.lower().removeprefix("@@")
    start = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?" if body.startswith("||") else ""
    rest = body.removeprefix("||")
    regex = "".join(".*" if c == "*" else r"(?:[^a-z0-9_.%-]|\Z)" if c == "^" else re.escape(c) for c in rest)
    framed = ("." if start else "*") + rest + "*"
    tokens = {m[0] for m in re.finditer(_TOKEN, framed) if framed[m.start() - 1] != "*" and framed[m.end()] != "*"}
    return Pattern(text, text.startswith("@@"), start + regex, tuple(sorted(tokens)))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty where there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1), *_LOW)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def _site_rule(what: int) -> Column:
    """The name or verdict of the longest fitting rule, or null."""
    out = None
    for rule in sorted(SITE_RULES, key=lambda r: -len(r[0] + r[1])):
        host, path, verdict = rule
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        value = F.lit((host + path, verdict)[what])
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def token_counts(urls: DataFrame, words: Sequence[str]) -> dict[str, int]:
    """How many urls of the whole table have each of these words; the result is as large as the list of words."""
    tokens = F.array_distinct(F.split(F.translate("url", *_LOW), "[^a-z0-9]+"))
    seen = urls.select(F.explode(tokens).alias("t")).where(F.col("t").isin(list(words))) if words else None
    return dict(seen.groupBy("t").count().collect()) if seen is not None else {}


def index(patterns: Sequence[Pattern], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rules by the rarest of their words, and the rules without a sure word, which every url tries."""
    by_word: dict[str, list[int]] = {}
    always = []
    for k, p in enumerate(patterns):
        if p.tokens:
            by_word.setdefault(min(p.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(k)
        else:
            always.append(k)
    return by_word, always


def filter_urls(pages: DataFrame, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern for each row of (page_id, url).

    ``rule`` is the longest fitting rule of SITE_RULES; without one ``verdict`` is that of the first pattern that matches,
    exceptions first, else allow. ``pattern`` names it. The list of patterns is an argument of the job and goes to each task.

    A null url, or one without ://: empty host and path, no site rule; patterns still see its text. Rows are independent; one
    whose page_id is null or repeated is judged like any other. An empty table gives no rows; other columns are ignored.
    """
    parsed = sorted(map(parse, patterns), key=lambda p: not p.allows)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    by_word, always = index(parsed, token_counts(pages, sorted({t for p in parsed for t in p.tokens})))
    compiled: dict[int, re.Pattern] = {}
    lower = str.maketrans(*_LOW)
    word = re.compile(_TOKEN)

    def judge(page_id, url, host, path, rule, verdict):
        low = (url or "").translate(lower)
        found = None
        if rule is None:
            for k in sorted({k for t in set(word.findall(low)) for k in by_word.get(t, ())}.union(always)):
                if k not in compiled:
                    compiled[k] = re.compile(parsed[k].regex)
                if compiled[k].search(low):
                    found = parsed[k]
                    break
        yield (page_id, host, path, rule, verdict or ("block" if found and not found.allows else "allow"), found and found.text)

    based = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    based = based.withColumn("rule", _site_rule(0)).withColumn("verdict", _site_rule(1))
    return per_row(based, judge, "page_id long, host string, path string, rule string, verdict string, pattern string",
                   ["page_id", "url", "host", "path", "rule", "verdict"])
