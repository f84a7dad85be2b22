"""Text queries (F1-F5, T1-T6, T11-T15, T22-T24) over documents, benchmark and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as FT
from tessera.functions import vectors as FV
from tessera.operators import aggregate as A
from tessera.operators import joins as J
from tessera.operators import sampling as S
from tessera.operators import text as T
from tessera.plans.registry import query
from tessera.session import Tables, cut_lineage

WP = FT.WORDPUNCT_PATTERN


def _docs(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", FT.wordpunct_tokens("text").alias("tokens"))


def _split(spark, sf_dir, frac=0.75, seed="lm"):
    d = _docs(spark, sf_dir)
    return S.split_hash(d, "doc_id", frac, seed)


def _toks_sql(src="documents"):
    return f"toks AS (SELECT doc_id, regexp_extract_all(lower(text), '{WP}', 1) AS t FROM {src})"


def _events_sql(n, src="toks"):
    pad = ", ".join(["'_UNK_'"] * (n - 1))
    prefix = f"array_to_string(a[i + 1:i + {n - 1}], ' ')" if n > 1 else "''"
    return (f"ev AS (SELECT doc_id, {prefix} AS prefix, a[i + {n}] AS token "
            f"FROM (SELECT doc_id, list_concat([{pad}]::VARCHAR[], t, ['_EOS_']) AS a, len(t) AS L FROM {src}), "
            f"range(0, L + 1) r(i))")


def _split_sql(frac=0.75, seed="lm"):
    thr = format(int(frac * 2 ** 32), "08x")
    return (f"train_docs AS (SELECT * FROM documents WHERE substr(md5(CAST(doc_id AS VARCHAR) || '{seed}'), 1, 8) < '{thr}'),"
            f" test_docs AS (SELECT * FROM documents WHERE substr(md5(CAST(doc_id AS VARCHAR) || '{seed}'), 1, 8) >= '{thr}')")


# ---------------------------------------------------------------- F: scalar text functions

@query("f1_wordpunct", f"""
WITH {_toks_sql()} SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS digest FROM toks
""")
def f1_wordpunct(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", F.size(FT.wordpunct_tokens("text")).alias("n_tokens"),
                    F.md5(FT.wordpunct("text")).alias("digest"))


@query("f2_tweet_tokens")
def f2_tweet_tokens(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    return c.select("conv_id", "turn", F.size(FT.tweet_tokens("text")).alias("n_tokens"))


@query("f3_assemble_line", """
SELECT doc_id, md5('<s> ' || replace(source || ' ; ' || text, chr(10), ' ') || ' </s>') AS digest,
       length('<s> ' || replace(source || ' ; ' || text, chr(10), ' ') || ' </s>') AS n_chars FROM documents
""")
def f3_assemble_line(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    line = FT.assemble_line("source", "text", max_len=None, bos="<s>", eos="</s>")
    return d.select("doc_id", F.md5(line).alias("digest"), F.length(line).alias("n_chars"))


_VOCAB1000 = f"""
{_toks_sql()}, flat AS (SELECT doc_id, unnest(t) AS token FROM toks),
counts AS (SELECT token, count(*) AS n FROM flat GROUP BY token),
vocab AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS token_id FROM counts ORDER BY n DESC, token LIMIT 1000)
"""


@query("f4_pad_ids", f"""
WITH {_VOCAB1000},
pos AS (SELECT doc_id, generate_subscripts(t, 1) AS i, unnest(t) AS token FROM toks),
ids AS (SELECT p.doc_id, list(coalesce(v.token_id, 0) ORDER BY p.i) AS x FROM pos p LEFT JOIN vocab v USING (token) GROUP BY p.doc_id)
SELECT doc_id, array_to_string(list_concat(x[1:64], list_resize([]::BIGINT[], greatest(64 - len(x), 0), -1)), ' ') AS ids FROM ids
""")
def f4_pad_ids(spark, sf_dir):
    """Token ids (top-1000 vocabulary, UNK = 0) right-padded / truncated to 64 with PAD = -1."""
    t = Tables(spark, sf_dir)
    docs = t.documents.select("doc_id", FT.wordpunct_tokens("text").alias("t"))
    top = A.vocab_topk(A.token_counts(docs.select(F.explode("t").alias("token"))), 1000).collect()  # bounded by k
    vocab = spark.createDataFrame([(r["token"], i + 1) for i, r in enumerate(top)], "token string, token_id long")
    kept = docs.select("doc_id", F.posexplode(F.slice("t", 1, 64)).alias("pos", "token"))  # what truncation leaves goes to the join
    ids = J.lookup_ids(kept, vocab, unk_id=0)
    seq = ids.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token_id"))),
                                                lambda s: s["token_id"]).alias("ids"))
    padded = seq.select("doc_id", FT.pad_ids("ids", 64, pad=-1).alias("ids"))
    return padded.select("doc_id", F.array_join("ids", " ").alias("ids"))


@query("f5_softmax_sharpen", """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: exp(x - list_max(embedding))) AS ex FROM embeddings),
p AS (SELECT vec_id, list_transform(ex, lambda v: v / list_sum(ex)) AS sm FROM s),
q AS (SELECT vec_id, sm, list_transform(sm, lambda v: power(v, 2.0)) AS pw FROM p)
SELECT vec_id, round(list_max(sm), 9) AS p_max, round(list_max(pw) / list_sum(pw), 9) AS sharp_max FROM q
""")
def f5_softmax_sharpen(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    sm = FV.softmax(F.col("embedding").cast("array<double>"))
    d = e.select("vec_id", sm.alias("sm"))
    return d.select("vec_id", F.round(F.array_max("sm"), 9).alias("p_max"),
                    F.round(F.array_max(FV.sharpen("sm", 0.5)), 9).alias("sharp_max"))


# ---------------------------------------------------------------- T1-T6: n-gram language model

@query("t1_ngram_counts", f"WITH {_toks_sql()}, {_events_sql(3)} SELECT prefix, token, count(*) AS n FROM ev GROUP BY ALL")
def t1_ngram_counts(spark, sf_dir):
    return T.ngram_counts(_docs(spark, sf_dir), "tokens", 3)


@query("t2_ngram_probs", f"""
WITH {_toks_sql()}, {_events_sql(2)}, c AS (SELECT prefix, token, count(*) AS n FROM ev GROUP BY ALL)
SELECT prefix, token, n, round(n / sum(n) OVER (PARTITION BY prefix), 9) AS p FROM c
""")
def t2_ngram_probs(spark, sf_dir):
    r = T.ngram_probs(T.ngram_counts(_docs(spark, sf_dir), "tokens", 2))
    return r.withColumn("p", F.round("p", 9))


_LAPLACE_BASE = f"""
WITH {_toks_sql()}, {_events_sql(2)}, c AS (SELECT prefix, token, count(*) AS n FROM ev GROUP BY ALL),
V AS (SELECT count(DISTINCT token) AS nv FROM c),
st AS (SELECT prefix, sum(n) AS ptot, count(*) AS pk FROM c GROUP BY prefix)
"""


@query("t3_laplace_probs", _LAPLACE_BASE + """
SELECT c.prefix, c.token, c.n, round((c.n + 1.0) / (st.ptot + 1.0 * V.nv), 12) AS p FROM c JOIN st USING (prefix), V
""")
def t3_laplace_probs(spark, sf_dir):
    r = T.laplace_probs(T.kept(T.ngram_counts(_docs(spark, sf_dir), "tokens", 2), "ngrams"), 1.0)
    return r.withColumn("p", F.round("p", 12))


@query("t3_laplace_missing", _LAPLACE_BASE + """
SELECT prefix, round(greatest(0.0, 1 - (ptot + 1.0 * pk) / (ptot + 1.0 * V.nv)) / greatest(1, V.nv - pk), 12) AS p_missing FROM st, V
""")
def t3_laplace_missing(spark, sf_dir):
    r = T.laplace_missing(T.kept(T.ngram_counts(_docs(spark, sf_dir), "tokens", 2), "ngrams"), 1.0)
    return r.withColumn("p_missing", F.round("p_missing", 12))


_KN_SQL = f"""
WITH {_toks_sql()}, {_events_sql(3)},
c3 AS (SELECT prefix, token, count(*) AS n FROM ev GROUP BY ALL),
c2 AS (SELECT split_part(prefix, ' ', 2) AS prefix, token, count(*) AS n FROM c3 GROUP BY ALL),
p1 AS (SELECT token, count(*) / (SELECT count(*) FROM c2) AS p FROM c2 GROUP BY token),
s2 AS (SELECT prefix, sum(n) AS ch, count(*) AS k FROM c2 GROUP BY prefix),
p2 AS (SELECT prefix, token, greatest(n - 0.75, 0) / ch + 0.75 * k / ch * p1.p AS p FROM c2 JOIN s2 USING (prefix) JOIN p1 USING (token)),
s3 AS (SELECT prefix, sum(n) AS ch, count(*) AS k FROM c3 GROUP BY prefix),
p3 AS (SELECT c3.prefix, c3.token, greatest(n - 0.75, 0) / ch + 0.75 * k / ch * p2.p AS p
       FROM c3 JOIN s3 USING (prefix) JOIN p2 ON p2.prefix = split_part(c3.prefix, ' ', 2) AND p2.token = c3.token)
"""


@query("t4_kneser_ney_mass", _KN_SQL + "SELECT prefix, round(sum(p), 9) AS mass FROM p3 GROUP BY prefix")
def t4_kneser_ney_mass(spark, sf_dir):
    """Total Kneser-Ney mass on the seen continuations of every trigram prefix (must be <= 1)."""
    kn = T.kneser_ney(_docs(spark, sf_dir), "tokens", 3)
    return kn.groupBy("prefix").agg(F.round(F.sum("p"), 9).alias("mass"))


def _ppl_sql(n, smoothing):
    base = f"""
WITH {_split_sql()}, {_toks_sql('train_docs').replace('toks AS', 'trt AS')}, {_toks_sql('test_docs').replace('toks AS', 'tet AS')},
{_events_sql(n, 'trt').replace('ev AS', 'trev AS')}, {_events_sql(n, 'tet').replace('ev AS', 'teev AS')},
c AS (SELECT prefix, token, count(*) AS n FROM trev GROUP BY ALL),
st AS (SELECT prefix, sum(n) AS ptot, count(*) AS pk FROM c GROUP BY prefix),
V AS (SELECT count(DISTINCT token) AS nv FROM c),
m AS (SELECT prefix, token, count(*) AS m FROM teev GROUP BY ALL),
j AS (SELECT m.m, c.n, st.ptot, st.pk, V.nv FROM m LEFT JOIN c USING (prefix, token) LEFT JOIN st USING (prefix), V)
"""
    if smoothing == "mle":
        p = "coalesce(n / ptot, 0.0)"
    else:
        p = ("CASE WHEN ptot IS NULL THEN 1.0 / greatest(1, nv) WHEN n IS NOT NULL THEN (n + 1.0) / (ptot + 1.0 * nv) "
             "ELSE greatest(0.0, 1 - (ptot + 1.0 * pk) / (ptot + 1.0 * nv)) / greatest(1, nv - pk) END")
    return base + f"""
SELECT round(-sum(m * CASE WHEN {p} > 0 THEN greatest(ln({p}), {T.MIN_LOGPROB!r}) ELSE {T.MIN_LOGPROB!r} END) / sum(m), 9)
       AS log_perplexity, CAST(sum(m) AS BIGINT) AS n_tokens FROM j
"""


def _ppl(spark, sf_dir, n, smoothing):
    train, test = _split(spark, sf_dir)
    # below trigrams joined to the test n-grams and summed per prefix
    counts = T.ngram_parts(train, "tokens", n) if n > 2 else T.kept(T.ngram_counts(train, "tokens", n), "ngrams")
    r = T.perplexity(counts, test, "tokens", n, smoothing, train=train)
    # log-perplexity: the clamp at 1e-50 makes perplexity itself astronomically large, so it is
    # compared in log space where 9 decimals are far inside double precision
    return r.select(F.round("log_perplexity", 9).alias("log_perplexity"), F.col("n_tokens").cast("long").alias("n_tokens"))


for _n in (1, 2, 3):
    query(f"t5_perplexity_mle_n{_n}", _ppl_sql(_n, "mle"))(
        lambda spark, sf_dir, _n=_n: _ppl(spark, sf_dir, _n, "mle"))
    query(f"t5_perplexity_laplace_n{_n}", _ppl_sql(_n, "laplace"))(
        lambda spark, sf_dir, _n=_n: _ppl(spark, sf_dir, _n, "laplace"))


_NEXT_BASE = f"""
WITH {_toks_sql()}, {_events_sql(2)}, c AS (SELECT prefix, token, count(*) AS n FROM ev GROUP BY ALL),
pr AS (SELECT prefix, token, n / sum(n) OVER (PARTITION BY prefix) AS p FROM c)
"""


@query("t6_next_token_top_p", _NEXT_BASE + """
, t AS (SELECT prefix, token, power(p, 1 / 0.7) / sum(power(p, 1 / 0.7)) OVER (PARTITION BY prefix) AS q FROM pr),
r AS (SELECT *, sum(q) OVER (PARTITION BY prefix ORDER BY q DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             row_number() OVER (PARTITION BY prefix ORDER BY q DESC, token) AS rn FROM t),
k AS (SELECT * FROM r WHERE cum <= 0.9 OR rn = 1)
SELECT prefix, token, round(q / sum(q) OVER (PARTITION BY prefix), 9) AS q FROM k
""")
def t6_next_token_top_p(spark, sf_dir):
    probs = T.ngram_probs(T.ngram_counts(_docs(spark, sf_dir), "tokens", 2))
    r = T.next_token_dist(probs, temperature=0.7, top_p=0.9)
    return r.withColumn("q", F.round("q", 9))


@query("t6_next_token_top_k_min_p", _NEXT_BASE + """
, r AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY p DESC, token) AS rn FROM pr),
k AS (SELECT * FROM r WHERE rn <= 5),
m AS (SELECT * FROM (SELECT *, max(p) OVER (PARTITION BY prefix) AS mx FROM k) WHERE p >= 0.1 * mx)
SELECT prefix, token, round(p / sum(p) OVER (PARTITION BY prefix), 9) AS q FROM m
""")
def t6_next_token_top_k_min_p(spark, sf_dir):
    probs = T.ngram_probs(T.ngram_counts(_docs(spark, sf_dir), "tokens", 2))
    r = T.next_token_dist(probs, temperature=1.0, top_k=5, min_p=0.1)
    return r.withColumn("q", F.round("q", 9))


@query("t6_next_token_argmax", _NEXT_BASE + """
SELECT prefix, token, 1.0 AS q FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY p DESC, token) AS rn FROM pr)
WHERE rn = 1
""")
def t6_next_token_argmax(spark, sf_dir):
    probs = T.ngram_probs(T.ngram_counts(_docs(spark, sf_dir), "tokens", 2))
    return T.next_token_dist(probs, temperature=0)


# ---------------------------------------------------------------- T11-T14: bag of words, NB

_NB_BASE = f"""
WITH {_split_sql(0.5, 'nb')},
lab AS (SELECT d.doc_id, regexp_extract_all(lower(d.text), '{WP}', 1) AS t, l.toxic,
               substr(md5(CAST(d.doc_id AS VARCHAR) || 'nb'), 1, 8) < '80000000' AS is_train
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
flat AS (SELECT doc_id, toxic, is_train, unnest(t) AS token FROM lab),
vocab AS (SELECT token FROM flat WHERE is_train GROUP BY token ORDER BY count(*) DESC, token LIMIT 10000),
bow AS (SELECT doc_id, token, count(*) AS n FROM flat WHERE token IN (SELECT token FROM vocab) GROUP BY ALL)
"""


def _nb_inputs(spark, sf_dir):
    """Labelled documents, their token counts (tokenised once and materialised), both parts of the split, the vocabulary."""
    t = Tables(spark, sf_dir)
    texts = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "toxic"), "doc_id")
    counts = cut_lineage(
        texts.select("doc_id", F.explode(FT.wordpunct_tokens("text")).alias("token"))
        .groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")))
    lab = t.labels.select("doc_id", "toxic").join(t.documents.select("doc_id"), "doc_id")
    train, test = S.split_hash(lab, "doc_id", 0.5, "nb")
    seen, _ = S.split_hash(counts, "doc_id", 0.5, "nb")
    top = A.vocab_topk(seen.groupBy("token").agg(F.sum("n").alias("n")), 10000).collect()
    vocab = spark.createDataFrame([(r["token"], r["n"]) for r in top], "token string, n long")  # bounded by k
    return lab, train, test, vocab, counts.join(vocab.select("token"), "token", "left_semi")


@query("t11_bow", _NB_BASE + "SELECT doc_id, token, n FROM bow")
def t11_bow(spark, sf_dir):
    *_, bows = _nb_inputs(spark, sf_dir)
    return bows.select("doc_id", "token", "n")


@query("t12_tfidf", _NB_BASE + """
, dfq AS (SELECT token, count(DISTINCT doc_id) AS df FROM bow GROUP BY token),
tf AS (SELECT b.doc_id, b.token, b.n * ln((SELECT count(*) FROM lab) / (dfq.df + 1.0)) AS v FROM bow b JOIN dfq USING (token)),
nr AS (SELECT doc_id, sqrt(sum(v * v)) AS nrm FROM tf GROUP BY doc_id)
SELECT doc_id, token, round(v / nrm, 9) AS tfidf FROM tf JOIN nr USING (doc_id)
""")
def t12_tfidf(spark, sf_dir):
    lab, _, _, _, bows = _nb_inputs(spark, sf_dir)
    r = T.tfidf(bows, "doc_id", lab.count(), 1.0, normalize=True)
    return r.select("doc_id", "token", F.round("tfidf", 9).alias("tfidf"))


_NB_FIT = _NB_BASE + """
, wc AS (SELECT b.token, sum(CASE WHEN l.toxic = 0 THEN b.n ELSE 0 END) AS c0, sum(CASE WHEN l.toxic = 1 THEN b.n ELSE 0 END) AS c1
         FROM bow b JOIN lab l USING (doc_id) WHERE l.is_train GROUP BY b.token),
full_ AS (SELECT v.token, coalesce(wc.c0, 0) + 1.0 AS c0, coalesce(wc.c1, 0) + 1.0 AS c1 FROM vocab v LEFT JOIN wc USING (token)),
probs AS (SELECT token, c0 / sum(c0) OVER () AS p0, c1 / sum(c1) OVER () AS p1 FROM full_),
pri AS (SELECT ln(count(*) FILTER (WHERE toxic = 0) / count(*)) AS lp0, ln(count(*) FILTER (WHERE toxic = 1) / count(*)) AS lp1
        FROM lab WHERE is_train),
sc AS (SELECT l.doc_id, l.toxic, coalesce(sum(b.n * ln(p.p0)), 0) + any_value(pri.lp0) AS score0,
              coalesce(sum(b.n * ln(p.p1)), 0) + any_value(pri.lp1) AS score1
       FROM lab l LEFT JOIN bow b USING (doc_id) LEFT JOIN probs p USING (token), pri WHERE NOT l.is_train GROUP BY l.doc_id, l.toxic)
"""


def _nb(spark, sf_dir):
    _, train, test, vocab, bows = _nb_inputs(spark, sf_dir)
    train_b, test_b = S.split_hash(bows, "doc_id", 0.5, "nb")
    priors, probs = T.text_nb_fit(train_b, train.select("doc_id", "toxic"), "doc_id", "toxic", vocab)
    scores = T.text_nb_score(test_b, test.select("doc_id"), "doc_id", priors, probs)
    return scores.join(test.select("doc_id", "toxic"), "doc_id"), probs


@query("t13_text_nb_scores", _NB_FIT + """
SELECT doc_id, round(score0, 6) AS score0, round(score1, 6) AS score1, CAST(score1 > score0 AS INTEGER) AS pred FROM sc
""")
def t13_text_nb_scores(spark, sf_dir):
    s, _ = _nb(spark, sf_dir)
    return s.select("doc_id", F.round("score0", 6).alias("score0"), F.round("score1", 6).alias("score1"), "pred")


@query("t13_text_nb_accuracy", _NB_FIT + """
SELECT count(*) AS n_test, round(avg(CAST(CAST(score1 > score0 AS INTEGER) = toxic AS DOUBLE)), 9) AS accuracy FROM sc
""")
def t13_text_nb_accuracy(spark, sf_dir):
    s, _ = _nb(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("n_test"),
                 F.round(F.avg((F.col("pred") == F.col("toxic")).cast("double")), 9).alias("accuracy"))


@query("t14_ratio_words", _NB_FIT + """
SELECT token, round(p1 / p0, 9) AS ratio FROM probs ORDER BY p1 / p0 DESC, token LIMIT 25
""")
def t14_ratio_words(spark, sf_dir):
    _, probs = _nb(spark, sf_dir)
    r = T.ratio_words(probs, 25)
    return r.select("token", F.round("ratio", 9).alias("ratio"))


# ---------------------------------------------------------------- T15, T22-T24

@query("t15_skipgram_pairs", f"""
WITH b AS (SELECT regexp_extract_all(lower(text), '{WP}', 1) AS a FROM benchmark),
p AS (SELECT a[i] AS center, a[j] AS context FROM b, range(1, len(a) + 1) r(i), range(1, len(a) + 1) s(j)
      WHERE j <> i AND j >= i - 2 AND j <= i + 2)
SELECT center, context, count(*) AS n FROM p GROUP BY ALL
""")
def t15_skipgram_pairs(spark, sf_dir):
    b = Tables(spark, sf_dir).benchmark.select(FT.wordpunct_tokens("text").alias("tokens"))
    return T.skipgram_pairs(b, "tokens", 2).groupBy("center", "context").agg(F.count(F.lit(1)).alias("n"))


@query("t15_cbow_windows", f"""
WITH b AS (SELECT regexp_extract_all(lower(text), '{WP}', 1) AS a FROM benchmark)
SELECT array_to_string(list_concat(a[i - 2:i - 1], a[i + 1:i + 2]), ' ') AS context, a[i] AS target
FROM b, range(3, len(a) - 1) r(i)
""")
def t15_cbow_windows(spark, sf_dir):
    b = Tables(spark, sf_dir).benchmark.select(FT.wordpunct_tokens("text").alias("tokens"))
    r = T.cbow_windows(b, "tokens", 2)
    return r.select(F.array_join("context", " ").alias("context"), "target")


@query("t22_corpus_bleu", r"""
WITH p AS (SELECT doc_id, text AS ref, regexp_replace(regexp_replace(text, ' the ', ' a ', 'g'), '\.\n', chr(10), 'g') AS hyp FROM documents),
w AS (SELECT doc_id, regexp_extract_all(replace(ref, '@@ ', ''), '[^\x20\x09-\x0D]+') AS r, regexp_extract_all(replace(hyp, '@@ ', ''), '[^\x20\x09-\x0D]+') AS h FROM p),
g AS (SELECT doc_id, n, array_to_string(r[i:i + n - 1], ' ') AS g, 0 AS hyp FROM w, (SELECT unnest([1, 2, 3, 4]) AS n) k, unnest(generate_series(1, len(r) - n + 1)) AS u(i)
      UNION ALL SELECT doc_id, n, array_to_string(h[i:i + n - 1], ' '), 1 FROM w, (SELECT unnest([1, 2, 3, 4]) AS n) k, unnest(generate_series(1, len(h) - n + 1)) AS u(i)),
c AS (SELECT doc_id, n, g, sum(hyp) AS ch, sum(1 - hyp) AS cr FROM g GROUP BY doc_id, n, g),
t AS (SELECT n, sum(least(ch, cr))::DOUBLE AS m, sum(ch)::DOUBLE AS t, sum(cr)::DOUBLE AS u FROM c GROUP BY n),
x AS (SELECT max(t) FILTER (n = 1) AS hyp_len, max(u) FILTER (n = 1) AS ref_len, """ + ", ".join(
    f"max(m) FILTER (n = {n}) AS match{n}, max(t) FILTER (n = {n}) AS total{n}" for n in (1, 2, 3, 4)) + """, sum(ln((m + 1) / t)) / 4 AS logs FROM t)
SELECT round(100 * CASE WHEN hyp_len > ref_len THEN 1 ELSE exp(1 - ref_len / hyp_len) END * exp(logs), 9) AS bleu,
       round(CASE WHEN hyp_len > ref_len THEN 1 ELSE exp(1 - ref_len / hyp_len) END, 9) AS bp, hyp_len, ref_len,
       match1, match2, match3, match4, total1, total2, total3, total4 FROM x
""")
def t22_corpus_bleu(spark, sf_dir):
    """Documents against a perturbed copy (every " the " -> " a ", sentences ending in '.' lose it)."""
    d = Tables(spark, sf_dir).documents
    pairs = d.select("doc_id", F.col("text").alias("ref"),
                     F.regexp_replace(F.regexp_replace("text", " the ", " a "), r"\.\n", "\n").alias("hyp"))
    r = T.corpus_bleu(pairs, "doc_id", "ref", "hyp")
    return r.withColumns({c: F.round(c, 9) for c in ("bleu", "bp")})


@query("t23_word_dropout")
def t23_word_dropout(spark, sf_dir):
    """p = 0.1 dropout of token ids (PAD = -1 never dropped): share of UNK per document."""
    d = _docs(spark, sf_dir)
    ids = d.select("doc_id", F.transform("tokens", lambda x: F.length(x)).alias("ids"))
    drop = FT.word_dropout(F.col("ids"), 0.1, 42, F.col("doc_id"), unk=0, pad=-1)
    out = ids.select("doc_id", F.size("ids").alias("n"), F.size(F.filter(drop, lambda x: x == 0)).alias("n_unk"))
    return out


@query("t24_occlusion", _NB_FIT + f"""
, bt AS (SELECT item_id AS doc_id, regexp_extract_all(lower(text), '{WP}', 1) AS a FROM benchmark),
pos AS (SELECT doc_id, i - 1 AS pos, a[i] AS token FROM bt, range(1, len(a) + 1) r(i))
SELECT doc_id, pos::INTEGER AS pos, token, round(coalesce(ln(p1) - ln(p0), 0), 6) AS weight FROM pos LEFT JOIN probs USING (token)
""")
def t24_occlusion(spark, sf_dir):
    """Occlusion weights of the benchmark texts under the T13 naive-Bayes scorer, a sum over the tokens."""
    _, train, _, vocab, bows = _nb_inputs(spark, sf_dir)
    b, _ = S.split_hash(bows, "doc_id", 0.5, "nb")
    _, probs = T.text_nb_fit(b, train.select("doc_id", "toxic"), "doc_id", "toxic", vocab)
    bench = Tables(spark, sf_dir).benchmark.select(F.col("item_id").alias("doc_id"), FT.wordpunct_tokens("text").alias("tokens"))
    weights = T.occlusion_of_sums(bench, "doc_id", "tokens", probs.select("token", (F.log("p1") - F.log("p0")).alias("term")))
    return weights.withColumn("weight", F.round("weight", 6))
