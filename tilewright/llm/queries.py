"""The registered query of each operator, and its DuckDB text where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm.common import held_out, table
from tilewright.llm.lexical import rank_documents
from tilewright.llm.licenses import HINT, RULES, TERMS, names, scan_licenses
from tilewright.llm.mixing import SEED, mix
from tilewright.llm.neardup import near_duplicates
from tilewright.llm.packing import pack
from tilewright.llm.quality import score_quality
from tilewright.llm.rules import judge_quality
from tilewright.llm.runs import periodic_runs, repeat_tail
from tilewright.llm.secrets import scan_secrets
from tilewright.llm.tokenfiles import read_token_files, with_crc32, write_token_files
from tilewright.llm.toxicity import score_toxicity
from tilewright.llm.urls import PATTERNS, SITE_RULES, filter_urls, parse
from tilewright.llm.vectors import near_vectors
from tilewright.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


# All pairs that share a shingle, by sums over shingles; components by widening reach. For small inputs only.
_OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
h AS (SELECT doc_id, hash(sh) AS sh FROM s),
n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY 1),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM h a JOIN h b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM i JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 75 * (a.n + b.n - i)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""


@_query("op3_minhash_near_dedup", _OP3_SQL)
def _op3(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@_query("op6_cutting_stock_packing")
def _op6(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


_OP9_SQL = """
WITH RECURSIVE x AS (
  SELECT vec_id, label, CASE WHEN label IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    THEN CAST(embedding AS DOUBLE[]) END AS e FROM embeddings),
v AS (SELECT vec_id, label, e FROM x WHERE list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT l.v, r.root FROM r JOIN l ON l.u = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY 1),
n AS (SELECT u, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.node = vec_id LEFT JOIN n ON n.u = vec_id
"""


@_query("op9_pivot_near_vectors", _OP9_SQL)
def _op9(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def _folded(scores: DataFrame) -> DataFrame:
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query("op1_boosted_toxicity")
def _op1(spark, sf_dir):
    return _folded(score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@_query("op5_kernel_quality")
def _op5(spark, sf_dir):
    return _folded(score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@_query("op2_secret_scans")
def _op2(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _site_sql(what: int) -> str:
    cases = " ".join(f"WHEN (host = {_text(h)} OR ends_with(host, {_text('.' + h)})) AND starts_with(path, {_text(p)}) THEN {_text((h + p, v)[what])}"
                     for h, p, v in sorted(SITE_RULES, key=lambda r: -len(r[0] + r[1])))
    return f"CASE {cases} END"


def _pattern_sql(what: str) -> str:
    parsed = sorted(map(parse, PATTERNS), key=lambda p: not p.allows)
    value = lambda p: _text(p.text if what == "pattern" else "allow" if p.allows else "block")
    return "CASE " + " ".join(f"WHEN regexp_matches(low, {_text(p.regex.replace(chr(92) + 'Z', '$'))}) THEN {value(p)}" for p in parsed) + " END"


# Every pattern on every url.
_OP4_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM pages),
h AS (SELECT page_id, low, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, {_site_sql(0)} AS rule, {_site_sql(1)} AS site FROM h)
SELECT page_id, host, path, rule, coalesce(site, {_pattern_sql("verdict")}, 'allow') AS verdict,
  CASE WHEN rule IS NULL THEN {_pattern_sql("pattern")} END AS pattern FROM r
"""


@_query("op4_indexed_url_rules", _OP4_SQL)
def _op4(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"))


# Sources clamped so far are a prefix in order of size by weight: the level is the first at which no other cap is reached.
_OP8_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0 * source_size AS cap FROM s),
c AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS k FROM w),
l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
f AS (SELECT arg_min(level, k) AS level FROM l WHERE cap > level * weight),
t AS (SELECT source, source_size, CAST(least(cap, coalesce(f.level, 1e300) * weight) AS DOUBLE) AS target FROM w, f),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(whole * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - whole * source_size - before)) AS BIGINT) AS taken FROM r
"""


@_query("op8_capped_source_mix", _OP8_SQL)
def _op8(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).drop("source").withColumn("target", F.round("target", 6))


@_query("op7_voted_quality_rules")
def _op7(spark, sf_dir):
    return judge_quality(table(spark, sf_dir, "documents")).drop("quality")


def _op10_sql() -> str:
    """Sentences of both cuts as rows with their places; those within earlier ones go, and rules are applied one after the other."""
    known = "MAP {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in names().items()) + "}"
    mark = "chr(2)"  # RE2 has no look-around: a mark is set behind sentence ends first
    steps, last = [], "f"
    for k, (rule, name, terms) in enumerate(RULES):
        sign = _text("".join(f"|{n}|" for n in rule))
        steps.append(f"r{k} AS (SELECT doc_id, sentences, replace(seq, {sign}, '#') AS seq, CASE WHEN contains(seq, {sign}) AND NOT list_contains(l, {_text(name)}) THEN list_append(l, {_text(name)}) ELSE l END AS l,"
                     f" CASE WHEN contains(seq, {sign}) THEN list_append(t, {_text(terms)}) ELSE t END AS t FROM {last})")
        last = f"r{k}"
    order = " ".join(f"WHEN list_contains(t, {_text(t)}) THEN {_text(t)}" for t in TERMS)

    def pieces(blank: str, gap: str, opens: str) -> str:
        return (f"string_split(regexp_replace(regexp_replace(coalesce(text, ''), '{blank}', {mark}, 'g'), '([.!?:])[{gap}]+({opens})', '\\1' || {mark} || '\\2', 'g'), {mark})")

    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
c AS (SELECT r, 1 AS cut, {pieces('\\n+', ' \\t\\r', '[A-Z"(]')} AS ps FROM d
  UNION ALL SELECT r, 2, {pieces('\\n[ \\t\\r]*\\n', ' \\t\\r\\n', '[A-Z"(#*/]')} FROM d),
p AS (SELECT r, cut, unnest(range(1, len(ps) + 1)) AS i, unnest(ps) AS s FROM c),
n AS (SELECT *, length(regexp_replace(lower(s), '[^a-z0-9]+', '', 'g')) AS n, CASE WHEN regexp_matches(s, {_text(HINT)})
    THEN {known}[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))] END AS name FROM p),
e AS (SELECT *, sum(n) OVER (PARTITION BY r, cut ORDER BY i) AS stop FROM n),
k AS (SELECT r, stop - n AS start, stop, name FROM e WHERE name IS NOT NULL),
m AS (SELECT *, coalesce(max(stop) OVER (PARTITION BY r ORDER BY start, -stop, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM k),
g AS (SELECT r, list(name ORDER BY start, -stop, name) AS found FROM m WHERE stop > reached GROUP BY r),
f AS (SELECT doc_id, array_to_string(found, ',') AS sentences, coalesce(array_to_string(list_transform(found, lambda n: '|' || n || '|'), ''), '') AS seq,
    CAST([] AS VARCHAR[]) AS l, CAST([] AS VARCHAR[]) AS t FROM d LEFT JOIN g USING (r)),
{", ".join(steps)}
SELECT doc_id, coalesce(sentences, '') AS sentences, coalesce(array_to_string(l, ','), '') AS licenses,
  CASE {order} END AS terms FROM {last}
"""


@_query("op10_license_scans", _op10_sql())
def _op10(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


# Terms of all documents as rows, counted by document.
_OP11_SQL = r"""
WITH low AS (SELECT row_number() OVER () AS d, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
i AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY 1, 2),
w AS (SELECT d, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low),
n AS (SELECT d, count(*) AS n FROM w GROUP BY 1),
c AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM n),
f AS (SELECT d, doc_id, term, count(*) AS tf FROM w SEMI JOIN i USING (term) GROUP BY 1, 2, 3),
g AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM f, c GROUP BY term, nn),
m AS (SELECT d, 25 + (75 * n * nn) // l AS m FROM n, c),
s AS (SELECT item_id, d, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM f JOIN g USING (term) JOIN m USING (d) JOIN i USING (term) GROUP BY 1, 2, 3),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@_query("op11_ranked_lexical_search", _OP11_SQL)
def _op11(spark, sf_dir):
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op13_periodic_runs")
def _op13(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), change=repeat_tail)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@_query("op12_huffman_token_files")
def _op12(spark, sf_dir):
    path = shared_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return with_crc32(read_token_files(spark, path))
