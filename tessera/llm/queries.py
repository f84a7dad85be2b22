"""Registered queries of the training-data operators, with their DuckDB equivalents where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import arrow_tokens, bpe, collocations, hard_negatives, host_reputation, mixing, repetition, sharding, simhash, substring, toxicity, trie_dedup, warc
from tessera.session import Tables

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- 1 mixing

# Production tree: the sources' domains, languages by target share, sources evenly but for the bulk crawl.
LANG_WEIGHTS = {"en": 60, "de": 15, "fr": 15, "es": 10}
DOMAIN_WEIGHTS = {"crawl": 40, "reference": 35, "community": 25}


def domain_of(source: str) -> str:
    number = int(source.removeprefix("src"))
    return "crawl" if number == 0 else "reference" if number < 10 else "community"


def mixing_tree() -> list[mixing.Leaf]:
    return [
        mixing.Leaf(domain_of(s), lang, s, DOMAIN_WEIGHTS[domain_of(s)], weight, 1 + int(s[3:]) % 3)
        for s in (f"src{k}" for k in range(20)) for lang, weight in LANG_WEIGHTS.items()
    ]


def domain_column():
    number = F.regexp_extract("source", r"^src(\d+)$", 1)
    return F.when(number == "0", "crawl").when(F.length(number) == 1, "reference").otherwise("community")


def _mixing_sql(budget_percent: int, max_epochs: int, seed: int) -> str:
    tree = ", ".join(f"('{x.domain}', '{x.lang}', '{x.source}', {x.domain_weight}, {x.lang_weight}, {x.source_weight})" for x in mixing.with_others(mixing_tree()))

    def share(name: str, children: str, parent: str, child: str) -> str:
        """Deal the parent's budget to its children by weight, at most cap each."""
        return f"""
{name}_1 AS (SELECT *, coalesce(sum(cap) OVER w, 0) AS taken, coalesce(sum(weight) OVER w, 0) AS passed,
    sum(weight) OVER (PARTITION BY {parent}) AS total FROM {children}
  WINDOW w AS (PARTITION BY {parent} ORDER BY cap::DOUBLE / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_2 AS (SELECT *, cap::HUGEINT * (total - passed)::HUGEINT <= (budget - taken)::HUGEINT * weight AS short FROM {name}_1),
{name}_3 AS (SELECT *, budget - coalesce(sum(cap) FILTER (short) OVER (PARTITION BY {parent}), 0) AS rest,
    total - coalesce(sum(weight) FILTER (short) OVER (PARTITION BY {parent}), 0) AS open FROM {name}_2),
{name}_4 AS (SELECT *, CASE WHEN short THEN cap ELSE (rest::HUGEINT * weight) // greatest(open, 1) END AS low,
    CASE WHEN NOT short THEN (rest::HUGEINT * weight) % greatest(open, 1) END AS over_ FROM {name}_3),
{name}_5 AS (SELECT *, budget - sum(low) OVER (PARTITION BY {parent}) AS spare,
    row_number() OVER (PARTITION BY {parent} ORDER BY over_ DESC NULLS LAST, {child}) AS turn FROM {name}_4),
{name} AS (SELECT * EXCLUDE (budget), low + CASE WHEN NOT short AND turn <= spare THEN 1 ELSE 0 END AS budget FROM {name}_5)"""

    return f"""
WITH named(domain, lang, source, w1, w2, w3) AS (VALUES {tree}),
raw AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN regexp_full_match(source, 'src[0-9]') THEN 'reference' ELSE 'community' END AS domain,
         lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
slim AS (
  SELECT doc_id, domain, CASE WHEN (domain, lang) IN (SELECT (domain, lang) FROM named) THEN lang ELSE '{mixing.OTHER}' END AS lang,
         CASE WHEN (domain, lang, source) IN (SELECT (domain, lang, source) FROM named) THEN source ELSE '{mixing.OTHER}' END AS source, n_tokens FROM raw),
leaves AS (
  SELECT domain, lang, source, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, sum(n_tokens) AS tokens,
         sum(n_tokens) * {max_epochs} AS cap
  FROM slim JOIN named USING (domain, lang, source) GROUP BY ALL HAVING sum(n_tokens) > 0),
root AS (SELECT least(floor(sum(tokens) * {budget_percent} / 100), sum(cap))::BIGINT AS budget FROM leaves),
c1 AS (SELECT 0 AS root, domain, any_value(w1) AS weight, sum(cap) AS cap, (SELECT budget FROM root) AS budget FROM leaves GROUP BY ALL),
{share('d1', 'c1', 'root', 'domain')},
c2 AS (SELECT l.domain, l.lang, any_value(l.w2) AS weight, sum(l.cap) AS cap, any_value(d1.budget) AS budget
       FROM leaves l JOIN d1 USING (domain) GROUP BY l.domain, l.lang),
{share('d2', 'c2', 'domain', 'lang')},
c3 AS (SELECT l.domain, l.lang, l.source, l.w3 AS weight, l.cap, l.tokens, d2.budget FROM leaves l JOIN d2 USING (domain, lang)),
{share('d3', 'c3', 'domain, lang', 'source')},
plan AS (SELECT domain, lang, source, budget, budget // tokens AS epochs, budget % tokens AS rest FROM d3 WHERE budget > 0),
keyed AS (SELECT s.*, coalesce(p.budget, 0) AS leaf_budget, coalesce(p.epochs, 0) AS epochs, coalesce(p.rest, 0) AS rest,
    md5('{seed}:' || coalesce(p.epochs, 0) || ':' || s.doc_id) AS key FROM slim s LEFT JOIN plan p USING (domain, lang, source)),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id) - n_tokens AS place FROM keyed),
-- a document without words after the cut does not ride along; one before it does
cut AS (SELECT domain, lang, source, max((key, doc_id::VARCHAR)) AS last FROM placed WHERE place < rest GROUP BY ALL)
SELECT p.doc_id, p.domain, p.lang, p.source, p.n_tokens, p.leaf_budget::BIGINT AS leaf_budget, p.epochs::BIGINT AS epochs,
       p.rest > 0 AND p.place < p.rest AS partial,
       CASE WHEN p.place < p.rest THEN least(p.n_tokens, p.rest - p.place) ELSE 0 END::BIGINT AS partial_tokens,
       (p.epochs * p.n_tokens + CASE WHEN p.place < p.rest THEN least(p.n_tokens, p.rest - p.place) ELSE 0 END)::BIGINT AS drawn_tokens
FROM placed p
"""


@_query("op1_mix_sources", _mixing_sql(100, 4, 7))
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draw(Tables(spark, sf_dir).documents, mixing_tree(), domain_column(), budget_percent=100, max_epochs=4, seed=7)


# ---------------------------------------------------------------- 2 quality rules

def _repetition_sql(rules: repetition.RepetitionRules) -> str:
    lengths = sorted({*rules.ngram_percent, repetition.BASE_WINDOW})
    covered = ", ".join(f"coalesce(sum(length(word)) FILTER (n = {n}), 0) AS c{n}" for n in lengths)
    over = " OR ".join(f"100 * coalesce(c{n}, 0) > {most} * word_chars" for n, most in rules.ngram_percent.items())
    worst = ", ".join(f"coalesce(c{n}, 0)" for n in rules.ngram_percent)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
base AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols FROM d),
lines AS (SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
dup AS (SELECT doc_id, sum(c) AS n_lines, sum(c - 1)::BIGINT AS n_dup_lines,
    sum((c - 1) * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')))::BIGINT AS dup_line_chars FROM lines GROUP BY doc_id),
windows AS (SELECT doc_id, n, i, md5(array_to_string(ws[i:i + n - 1], ' ')) AS k FROM d, (SELECT unnest({lengths}) AS n) l,
    unnest(generate_series(1, len(ws) - n + 1)) AS t(i)),
twice AS (SELECT doc_id, n, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, n, k) > 1),
inside AS (SELECT DISTINCT doc_id, n, p FROM twice, unnest(generate_series(i, i + n - 1)) AS t(p)),
cover AS (SELECT doc_id, count(*) FILTER (n = {repetition.BASE_WINDOW}) AS n_repeat_words, {covered}
  FROM (SELECT i.*, d.ws[i.p] AS word FROM inside i JOIN d USING (doc_id)) GROUP BY doc_id),
joined AS (SELECT b.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    n_words < {repetition.BASE_MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {repetition.BASE_MAX_REPEAT_PERCENT} * n_words AS base_failed,
    {over} OR 100 * coalesce(dup_line_chars, 0) > {rules.line_percent} * word_chars
      OR 100 * coalesce(n_dup_lines, 0) > {rules.line_count_percent} * coalesce(n_lines, 0) AS too_much,
    coalesce(dup_line_chars, 0) AS dup_line_chars, greatest({worst})::BIGINT AS dup_ngram_chars
  FROM base b LEFT JOIN dup USING (doc_id) LEFT JOIN cover USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT too_much AS kept,
       dup_line_chars, dup_ngram_chars FROM joined
"""


@_query("op2_repetition_rules", _repetition_sql(repetition.RepetitionRules()))
def op2_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.measure(Tables(spark, sf_dir).documents)


# ---------------------------------------------------------------- 3 url filters

def _reputation_sql() -> str:
    fits = []
    for r in sorted(host_reputation.RULES, key=lambda r: -len(r.text)):
        name, _, prefix = r.text.partition("/")
        fits.append((f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{prefix}')", r))
    rule = "".join(f" WHEN {c} THEN '{r.text}'" for c, r in fits)
    verdict = "".join(f" WHEN {c} THEN '{'allow' if r.allow else 'block'}'" for c, r in fits)

    def prior(name: str, child: str, parent: str, key: str) -> str:
        """Pseudo-pages from the pooled intraclass correlation of the children within their parents."""
        return f"""
{name}_s AS (SELECT count(*) AS k, count(DISTINCT c.{key}) AS g, sum(c.n) AS n, sum(c.n * pow(c.b / c.n - p.b / p.n, 2)) AS ssb,
    sum(c.b * (1 - c.b / c.n)) AS ssw, sum(c.n * c.n / p.n) AS load FROM {child} c JOIN {parent} p USING ({key}) WHERE c.n > 0),
{name}_v AS (SELECT *, ssb / nullif(k - g, 0) AS msb, ssw / nullif(n - k, 0) AS msw, (n - load) / nullif(k - g, 0) AS n0 FROM {name}_s),
{name} AS (SELECT CASE WHEN k > 0 AND k = g THEN NULL WHEN k = 0 OR n = k OR msb - msw <= 0 THEN {host_reputation.MAX_PRIOR}
    ELSE least(greatest((1 - (msb - msw) / (msb + (n0 - 1) * msw)) / ((msb - msw) / (msb + (n0 - 1) * msw)),
                        {host_reputation.MIN_PRIOR}), {host_reputation.MAX_PRIOR}) END AS m FROM {name}_v)"""

    return rf"""
WITH r AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
o AS (SELECT doc_id AS page_id, (coalesce(quality = 0, false) OR coalesce(toxic = 1, false))::INT AS bad FROM labels
  WHERE quality IS NOT NULL OR toxic IS NOT NULL),
h0 AS (SELECT host, count(o.page_id)::DOUBLE AS n, coalesce(sum(o.bad), 0)::DOUBLE AS b FROM p LEFT JOIN o USING (page_id) GROUP BY host),
h1 AS (SELECT *, split_part(host, '.', -1) AS suffix FROM h0),
h AS (SELECT *, CASE WHEN host = suffix THEN host
    ELSE split_part(substr(host, 1, length(host) - length(suffix) - 1), '.', -1) || '.' || suffix END AS domain FROM h1),
d AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM h GROUP BY ALL),
s AS (SELECT suffix, 0 AS root, sum(n) AS n, sum(b) AS b FROM d GROUP BY ALL),
a AS (SELECT 0 AS root, sum(n) AS n, sum(b) AS b FROM s),
{prior('m1', 's', 'a', 'root')},
{prior('m2', 'd', 's', 'suffix')},
{prior('m3', 'h', 'd', 'domain')},
m AS (SELECT coalesce(m1.m, {host_reputation.MAX_PRIOR}) AS c1, m2.m IS NULL AS skip2, coalesce(m2.m, c1) AS c2, m3.m IS NULL AS skip3,
    coalesce(m3.m, c2) AS c3, (a.b + 1) / (a.n + 2) AS rate FROM a, m1, m2, m3),
s2 AS (SELECT suffix, CASE WHEN skip2 THEN rate ELSE (b + c1 * rate) / (n + c1) END AS p1 FROM s, m),
d2 AS (SELECT domain, CASE WHEN skip3 THEN p1 ELSE (b + c2 * p1) / (n + c2) END AS p2 FROM d JOIN s2 USING (suffix), m),
h2 AS (SELECT host, n, b, b + c3 * p2 AS al, n - b + c3 * (1 - p2) AS be FROM h JOIN d2 USING (domain), m),
h3 AS (SELECT host, n, b, al / (al + be) - {host_reputation.Z} * sqrt(al / (al + be) * (1 - al / (al + be)) / (al + be + 1))
    > {host_reputation.MARGIN} * rate AS blocked FROM h2, m)
SELECT page_id, host, path, CASE{rule} END AS rule, CASE{verdict} WHEN blocked THEN 'block' ELSE 'allow' END AS verdict,
       n::BIGINT AS n_labelled, b::BIGINT AS n_bad FROM p JOIN h3 USING (host)
"""


@_query("op3_host_reputation", _reputation_sql())
def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the labels with the page's id; bad is low quality or toxic."""
    t = Tables(spark, sf_dir)
    bad = F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(),
                 F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
    outcomes = t.labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return host_reputation.judge(t.pages, outcomes)


# ---------------------------------------------------------------- 4 near duplicates

@_query("op4_simhash_components")
def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(Tables(spark, sf_dir).documents)


# ---------------------------------------------------------------- 5 - 9

_OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM d, unnest(generate_series(1, len(ws) - 49)) AS t(i)),
later AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
gone AS (SELECT DISTINCT doc_id, p FROM later, unnest(generate_series(i, i + 49)) AS t(p)),
kept AS (SELECT d.doc_id, string_agg(d.ws[p], ' ' ORDER BY p) AS words, count(*) AS n FROM d, unnest(generate_series(1, len(ws))) AS t(p)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = d.doc_id AND g.p = t.p) GROUP BY d.doc_id),
islands AS (SELECT doc_id, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island FROM gone),
runs AS (SELECT doc_id, count(*) AS n_repeats, max(size) AS longest
  FROM (SELECT doc_id, island, count(*) AS size FROM islands GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(words, '')) AS kept_sha256,
       coalesce(n_repeats, 0)::BIGINT AS n_repeats, coalesce(longest, 0)::BIGINT AS longest_repeat
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
"""


@_query("op5_substring_dedup", _OP5_SQL)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal repeats, word ranges in the operator's result, as their number and the longest one's words."""
    found = substring.remove(Tables(spark, sf_dir).documents)
    longest = F.array_max(F.transform("repeats", lambda r: r["end"] - r["first"]))
    return found.withColumns({"n_repeats": F.size("repeats").cast("long"), "longest_repeat": F.coalesce(longest, F.lit(0).cast("long"))}).drop("repeats")


@_query("op6_minimax_shards")
def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(Tables(spark, sf_dir).documents, shards=16)


@_query("op7_arrow_tokens")
def op7_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_tokens.round_trip(Tables(spark, sf_dir).documents, public_tokenizers.path("byte_bpe_50k.json")).drop("file")


_OP8_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS lead_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN lead_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN lead_id <> page_id THEN lead_id END AS refers_to
FROM m
"""


@_query("op8_warc_round_trip", _OP8_SQL)
def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(Tables(spark, sf_dir).pages).drop("offset")


@_query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.decode(bpe.encode(Tables(spark, sf_dir).documents, ranks, pattern), ranks, pattern, digests=True)


# ---------------------------------------------------------------- 10 exact duplicates

_OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id
  FROM n)
"""


@_query("op10_trie_dedup", _OP10_SQL)
def op10_trie_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_dedup.assign(Tables(spark, sf_dir).documents)


# ---------------------------------------------------------------- 11 phrase collocations

_OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, ws[i:i + k - 1] AS words, count(*) AS f
      FROM w, (SELECT unnest([1, 2, 3]) AS k) t, unnest(generate_series(1, len(ws) - k + 1)) AS u(i) GROUP BY ALL),
c AS (SELECT * FROM g WHERE k >= 2 AND f >= 10),
longer AS (SELECT DISTINCT s.lang, s.words FROM c s JOIN c t ON t.lang = s.lang AND s.k = 2 AND t.k = 3
           AND (t.words[1:2] = s.words OR t.words[2:3] = s.words) WHERE 100 * t.f >= 50 * s.f),
cuts AS (SELECT c.lang, c.words, c.f AS a, cut, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
  FROM c, unnest(generate_series(1, c.k - 1)) AS u(cut)
  JOIN g x ON x.lang = c.lang AND x.words = c.words[1:cut] JOIN g y ON y.lang = c.lang AND y.words = c.words[cut + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
scored AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM lowest ANTI JOIN longer USING (lang, words))
SELECT lang, row_number() OVER v AS rank, phrase, a, l, r, n, score FROM scored JOIN totals USING (lang)
WINDOW v AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER v <= 2000
"""


@_query("op11_collocations", _OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(Tables(spark, sf_dir).documents)


# ---------------------------------------------------------------- 12 hard negatives

_OP12_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id, list_dot_product(a.v, c.v)::BIGINT AS score
      FROM r a JOIN r c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 3
"""


@_query("op12_hard_negatives", _OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(Tables(spark, sf_dir).embeddings)


# ---------------------------------------------------------------- 13 toxicity

@_query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return toxicity.toxicity(t.documents, t.labels)
