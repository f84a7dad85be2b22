"""Text statistics, n-gram language models and bag-of-words models.

Counts are long tables; a prefix is the space-joined previous ``n-1``
tokens (tokens never contain spaces), so every shuffle is keyed by plain
strings and partially aggregated before it moves.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.counting import counted
from tessera.operators.ranking import segmented_cumsum
from tessera.session import cut_lineage
from tessera.sources.files import scratch_path

# Padding and end-of-sequence tokens of the n-gram model.
UNK, EOS = "_UNK_", "_EOS_"
MIN_LOGPROB = math.log(10 ** -50.0)

#: Tokens of a task whose n-grams are counted at a time, and texts that are looked at together.
CHUNK = 1_000_000
SLICE = 256


def _padded(tokens: Column, n: int) -> Column:
    pad = F.array_repeat(F.lit(UNK), n - 1) if n > 1 else F.array().cast("array<string>")
    return F.concat(pad, tokens, F.array(F.lit(EOS)))


def ngram_events(df: DataFrame, tokens: str, n: int, keep: list[str] = ()) -> DataFrame:
    """One row ``(prefix, token)`` per position: n-1 UNK on the left, EOS appended.

    The padded array is materialised once per row, so each position costs
    O(n), not O(length).
    """
    d = df.select(*keep, _padded(F.col(tokens), n).alias("_pad"))
    p = F.col("_pad")
    events = F.transform(
        F.sequence(F.lit(0), F.size(p) - n),
        lambda i: F.struct(F.concat_ws(" ", *[F.element_at(p, i + j) for j in range(1, n)]).alias("prefix")
                           if n > 1 else F.lit("").alias("prefix"),
                           F.element_at(p, i + n).alias("token")))
    return d.select(*keep, F.inline(events))


def ngram_counts(df: DataFrame, tokens: str, n: int, chunk: int = CHUNK) -> DataFrame:
    """``(prefix, token, n)`` counts of the :func:`ngram_events`.

    The tasks number their tokens and count the n-grams of ``chunk`` tokens or so at a time by sorting numbers;
    only the distinct ones become strings and are added up by Spark.
    """
    # the chunks' counts are combined already: they move as they are, and are added up where they arrive
    return ngram_parts(df, tokens, n, chunk).repartition("prefix", "token").groupBy("prefix", "token").agg(F.sum("n").alias("n"))


def ngram_parts(df: DataFrame, tokens: str, n: int, chunk: int = CHUNK) -> DataFrame:
    """The counts of the chunks, which add up to :func:`ngram_counts`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                part = batch.column(0).slice(k, SLICE).drop_null()
                held.append(part)
                size += len(part.flatten())
                if size >= chunk:
                    yield from _counted_chunk(held, n)
                    held, size = [], 0
        if held:
            yield from _counted_chunk(held, n)

    return df.select(F.col(tokens).cast("array<string>")).mapInArrow(count, "prefix string, token string, n long")


def _counted_chunk(held: list[pa.Array], n: int) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of some token lists (null tokens are left out of a prefix, as ``concat_ws`` does) and their counts."""
    lengths = np.concatenate([pc.list_value_length(a).to_numpy(zero_copy_only=False) for a in held]).astype(np.int64)
    coded = pa.concat_arrays([a.flatten() for a in held]).dictionary_encode(null_encoding="encode")
    words = pa.concat_arrays([coded.dictionary, pa.array([UNK, EOS], coded.dictionary.type)])
    unk, eos = len(words) - 2, len(words) - 1
    # every text with n - 1 UNK before it and EOS behind it
    ends = np.cumsum(lengths + n)
    stream = np.full(int(ends[-1]) if len(ends) else 0, unk, np.int32)
    stream[ends - 1] = eos
    inside = np.ones(len(stream), bool)
    for k in range(n - 1):
        inside[ends - lengths - n + k] = False
    at = np.flatnonzero(inside)
    inside[ends - 1] = False
    stream[inside] = coded.indices.to_numpy()
    columns, times = counted([stream[at - n + 1 + k] for k in range(n)])
    for k in range(0, len(times), 1 << 16):
        *before, token = [words.take(pa.array(c[k : k + (1 << 16)])) for c in columns]
        if n > 2:
            prefix = pc.binary_join_element_wise(*before, " ", null_handling="skip")
        else:
            prefix = before[0].fill_null("") if before else pa.array([""] * len(token))
        yield pa.RecordBatch.from_arrays([prefix, token, pa.array(times[k : k + (1 << 16)], pa.int64())], ["prefix", "token", "n"])


def ngram_probs(counts: DataFrame) -> DataFrame:
    """MLE ``n / sum(n)`` per prefix (aggregate + join, no per-prefix window)."""
    tot = counts.groupBy("prefix").agg(F.sum("n").alias("_tot"))
    return counts.join(tot, "prefix").withColumn("p", F.col("n") / F.col("_tot")).drop("_tot")


def _prefix_stats(counts: DataFrame) -> DataFrame:
    return counts.groupBy("prefix").agg(F.sum("n").alias("ptot"), F.count(F.lit(1)).alias("pk"))


def laplace_probs(counts: DataFrame, delta: float = 1.0) -> DataFrame:
    """``(n + d) / (N + d V)`` for seen tokens; V = number of distinct next tokens
    (a scalar subquery: the plan stays lazy and the counts are not recomputed by an eager action)."""
    V = counts.select(F.countDistinct("token")).scalar()
    st = _prefix_stats(counts)
    return counts.join(st, "prefix").select(
        "prefix", "token", "n", ((F.col("n") + delta) / (F.col("ptot") + delta * V)).alias("p"))


def laplace_missing(counts: DataFrame, delta: float = 1.0) -> DataFrame:
    """Probability of any unseen token after each seen prefix,
    ``max(0, 1 - sum seen) / max(1, V - seen)``; an unseen prefix gives ``1 / V``."""
    V = counts.select(F.countDistinct("token")).scalar()
    st = _prefix_stats(counts)
    seen = (F.col("ptot") + delta * F.col("pk")) / (F.col("ptot") + delta * V)
    return st.select("prefix", (F.greatest(F.lit(0.0), 1 - seen) / F.greatest(F.lit(1), V - F.col("pk"))).alias(
        "p_missing"))


def perplexity(counts: DataFrame, test: DataFrame, tokens: str, n: int, smoothing: str = "mle",
               delta: float = 1.0, train: DataFrame | None = None) -> DataFrame:
    """T5: corpus perplexity ``exp(-sum max(log p, log 1e-50) / #tokens)``, EOS included.

    Test positions are first counted per ``(prefix, token)`` (partial
    aggregate), then joined to the model, so distinct n-grams move,
    not token occurrences.  When the training token table ``train`` is given, the
    Laplace vocabulary size comes from its distinct tokens (+ EOS) - the same set as
    the counts' next tokens - without generating the n-grams a second time.

    From trigrams on the n-grams of both sides move once, by their prefix, and ``counts`` may be
    :func:`ngram_parts`: a prefix has at most a row per word and chunk, and words of a short prefix are too many for a task.
    """
    if n > 2:
        both = counts.select("prefix", "token", "n", F.lit(0).cast("long").alias("m")).unionByName(
            ngram_parts(test, tokens, n).select("prefix", "token", F.lit(0).cast("long").alias("n"), F.col("n").alias("m")))
        both = both.repartition("prefix").groupBy("prefix", "token").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        both = both.withColumn("n", F.when(F.col("n") > 0, F.col("n")))
        of_prefix = Window.partitionBy("prefix")
        j = both.withColumn("ptot", F.sum("n").over(of_prefix)).withColumn("pk", F.count("n").over(of_prefix)).where("m > 0")
    else:
        ev = ngram_counts(test, tokens, n).withColumnRenamed("n", "m")
        j = ev.join(counts, ["prefix", "token"], "left").join(_prefix_stats(counts), "prefix", "left")
    if smoothing == "mle":
        p = F.coalesce(F.col("n") / F.col("ptot"), F.lit(0.0))
    else:
        if train is not None:
            V = train.select(F.explode(tokens).alias("_t")).select(F.countDistinct("_t") + 1).scalar()
        else:
            V = counts.select(F.countDistinct("token")).scalar()
        seen = (F.col("ptot") + delta * F.col("pk")) / (F.col("ptot") + delta * V)
        missing = F.greatest(F.lit(0.0), 1 - seen) / F.greatest(F.lit(1), V - F.col("pk"))
        p = (F.when(F.col("ptot").isNull(), F.lit(1.0) / F.greatest(F.lit(1), V))
             .when(F.col("n").isNotNull(), (F.col("n") + delta) / (F.col("ptot") + delta * V))
             .otherwise(missing))
    lp = F.when(p > 0, F.greatest(F.log(p), F.lit(MIN_LOGPROB))).otherwise(F.lit(MIN_LOGPROB))
    nll = -F.sum(F.col("m") * lp) / F.sum("m")
    return j.agg(nll.alias("log_perplexity"), F.exp(nll).alias("perplexity"), F.sum("m").alias("n_tokens"))


def kneser_ney(df: DataFrame, tokens: str, n: int, delta: float = 0.75) -> DataFrame:
    """T4: interpolated Kneser-Ney probabilities of seen ``(prefix, token)`` pairs.

    Highest order uses raw counts, lower orders continuation counts (number of
    distinct left contexts).  The texts are cut into n-grams of the highest order only: without its first word a
    distinct n-gram is one left context of the n-gram one shorter, so every order is counted from the one above.
    Orders are joined bottom-up: ``P(w|h) = max(c - d, 0)/c(h) + d * T(h)/c(h) * P(w|h')``, with the
    unigram continuation distribution at the bottom.

    N-grams are kept dealt by all words but the first: that adds them up, counts the order below and joins it,
    without another shuffle.  They move once more, by their prefix, of which every word has at most one row.
    """
    def dealt(rows: DataFrame, order: int, prefix: str) -> DataFrame:
        """The prefix as its first word ``_w`` and the rest ``_h``."""
        rest = F.array_join(F.slice(F.split(prefix, " "), 2, order - 2), " ") if order > 2 else F.lit("")
        return rows.select(F.substring_index(prefix, " ", 1).alias("_w"), rest.alias("_h"), "token", "n")

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_w", "_h", "token").agg(F.sum("n").alias("n"))

    counts = {n: bucketed(dealt(ngram_parts(df, tokens, n), n, "prefix"), ["_h", "token"], summed, "ngrams")}
    for order in range(n - 1, 1, -1):
        fewer = counts[order + 1].groupBy("_h", "token").agg(F.count(F.lit(1)).alias("n"))
        counts[order] = kept(dealt(fewer, order, "_h"), "ngrams")
    # unigram continuation probability
    types = counts[2].count()
    lower = counts[2].groupBy("token").agg(F.count(F.lit(1)).alias("_c")).select(
        F.lit("").alias("prefix"), "token", (F.col("_c") / F.lit(float(types))).alias("p"))
    for order in range(2, n + 1):
        cur = counts[order].join(lower.select(F.col("prefix").alias("_h"), "token", F.col("p").alias("_pl")), ["_h", "token"], "left")
        prefix = F.when(F.col("_h") == "", F.col("_w")).otherwise(F.concat("_w", F.lit(" "), "_h"))
        of_prefix = Window.partitionBy("prefix")
        cur = cur.select(prefix.alias("prefix"), "token", "n", "_pl").withColumn("_ch", F.sum("n").over(of_prefix)).withColumn(
            "_T", F.count(F.lit(1)).over(of_prefix))
        lower = cur.select("prefix", "token", (
            F.greatest(F.col("n") - delta, F.lit(0.0)) / F.col("_ch")
            + delta * F.col("_T") / F.col("_ch") * F.coalesce(F.col("_pl"), F.lit(0.0))).alias("p"))
    return lower


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: far smaller than a checkpoint of its rows."""
    path = f"{scratch_path(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: list[str], combine, name: str) -> DataFrame:
    """``combine`` of the rows dealt by ``by``, :func:`kept` so that readers find them dealt (the table has no name afterwards)."""
    spark, table = df.sparkSession, f"tessera_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = combine(df.repartition(n, *by)).write.format("parquet").bucketBy(n, *by)
    rows.option("path", scratch_path(spark, name)).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay until the application ends
    return found


def next_token_dist(probs: DataFrame, temperature: float = 1.0, top_k: int | None = None,
                    top_p: float | None = None, min_p: float | None = None) -> DataFrame:
    """Next-token distribution per prefix after temperature and truncation.

    ``temperature == 0`` keeps the arg-max (ties: smallest token).  Top-k keeps the
    k most likely; nucleus keeps tokens whose cumulative probability (sorted
    desc) is <= top_p, always at least one; min-p keeps ``p >= min_p * max p``.
    The kept probabilities are renormalised.  Sums and maxima per prefix are combined in the tasks first, the k most
    likely come from a limited window, and the cumulative probability from a scan over range partitioned rows, so a
    frequent prefix is in no single task.
    """
    w = Window.partitionBy("prefix").orderBy(F.desc("p"), "token")

    def per_prefix(d: DataFrame, value) -> DataFrame:
        return d.join(d.groupBy("prefix").agg(value.alias("_all")), "prefix")

    if temperature == 0:
        d = probs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
        return d.select("prefix", "token", F.lit(1.0).alias("q"))
    if temperature == 1.0:
        d = probs.withColumn("q", F.col("p"))  # p^(1/1) / sum = p: skip the no-op rescale
    else:
        d = per_prefix(probs.withColumn("q", F.pow("p", 1.0 / temperature)), F.sum("q"))
        d = d.withColumn("q", F.col("q") / F.col("_all")).drop("_all")
    if top_k is not None:
        d = d.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top_k).drop("_r")
    if min_p is not None:
        d = per_prefix(d, F.max("q")).where(F.col("q") >= min_p * F.col("_all")).drop("_all")
    if top_p is not None:
        d = segmented_cumsum(d.select("prefix", "token", "q"), "prefix", [F.desc("q"), F.col("token")], "q")
        d = d.where((F.col("_upto") <= top_p) | (F.col("_before") == 0)).drop("_upto", "_before")
    return per_prefix(d, F.sum("q")).select("prefix", "token", (F.col("q") / F.col("_all")).alias("q"))


# ------------------------------------------------------------------ bag of words

def bow(df: DataFrame, key: str, tokens: str, vocab: DataFrame) -> DataFrame:
    """Long bag of words ``(key, token, n)`` restricted to the vocabulary ``(token)``."""
    ex = df.select(key, F.explode(tokens).alias("token"))
    return ex.join(vocab.select("token"), "token", "left_semi").groupBy(key, "token").agg(
        F.count(F.lit(1)).alias("n"))


def tfidf(bows: DataFrame, key: str, n_docs: int, alpha: float = 1.0, normalize: bool = False) -> DataFrame:
    """``n * log(N / (df + alpha))``, optionally L2-normalised per document."""
    dfreq = bows.groupBy("token").agg(F.countDistinct(key).alias("_df"))
    out = bows.join(dfreq, "token").withColumn(
        "tfidf", F.col("n") * F.log(F.lit(float(n_docs)) / (F.col("_df") + alpha))).drop("_df")
    if normalize:
        norm = out.groupBy(key).agg(F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))).alias("_norm"))
        out = out.join(norm, key).withColumn("tfidf", F.coalesce(F.try_divide("tfidf", "_norm"), F.lit(0.0))).drop("_norm")
    return out


def text_nb_fit(bows: DataFrame, labels: DataFrame, key: str, label: str, vocab: DataFrame,
                delta: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Binary multinomial naive Bayes.

    Returns ``(priors(label, log_prior), word_probs(token, p0, p1))`` with
    ``p(w|c) = (count(w, c) + d) / sum_w (count(w, c) + d)`` over the whole
    vocabulary and unsmoothed class priors.
    """
    lab = labels.select(key, label)
    n = lab.count()
    priors = lab.groupBy(label).agg((F.log(F.count(F.lit(1)) / F.lit(float(n)))).alias("log_prior"))
    wc = bows.join(lab, key).groupBy("token").agg(
        F.sum(F.when(F.col(label) == 0, F.col("n")).otherwise(0)).alias("c0"),
        F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).alias("c1"))
    full = vocab.select("token").join(wc, "token", "left").fillna(0, ["c0", "c1"])
    full = full.withColumn("c0", F.col("c0") + delta).withColumn("c1", F.col("c1") + delta)
    t0 = full.select(F.sum("c0")).scalar()
    t1 = full.select(F.sum("c1")).scalar()
    probs = full.select("token", (F.col("c0") / t0).alias("p0"), (F.col("c1") / t1).alias("p1"))
    return priors, probs


def text_nb_score(bows: DataFrame, docs: DataFrame, key: str, priors: DataFrame, probs: DataFrame) -> DataFrame:
    """Per document ``score_c = log prior_c + sum n * log p(w|c)``, prediction = argmax (tie -> 0)."""
    pr = {r[0]: r[1] for r in priors.collect()}  # two classes
    s = bows.join(probs, "token").groupBy(key).agg(
        F.sum(F.col("n") * F.log("p0")).alias("_s0"), F.sum(F.col("n") * F.log("p1")).alias("_s1"))
    out = docs.select(key).join(s, key, "left").fillna(0.0, ["_s0", "_s1"])
    out = out.select(key, (F.col("_s0") + F.lit(pr.get(0, float("-inf")))).alias("score0"),
                     (F.col("_s1") + F.lit(pr.get(1, float("-inf")))).alias("score1"))
    return out.withColumn("pred", (F.col("score1") > F.col("score0")).cast("int"))


def ratio_words(probs: DataFrame, k: int = 25) -> DataFrame:
    """Words with the highest ``p(w|1) / p(w|0)``."""
    return probs.withColumn("ratio", F.col("p1") / F.col("p0")).orderBy(F.desc("ratio"), "token").limit(k)


# ------------------------------------------------------------------ word2vec pairs

def skipgram_pairs(df: DataFrame, tokens: str, window: int, vocab: DataFrame | None = None) -> DataFrame:
    """``(center, context)`` pairs within a symmetric window (no shuffle: per-row arrays).

    With ``vocab`` (tokens meeting the min count) unknown tokens are removed
    first, as the reference filters the corpus before pairing; every text keeps
    its own tokens, whatever other columns it has.
    """
    src = df
    if vocab is not None:
        texts = cut_lineage(df.select(F.col(tokens).alias("_all")).withColumn("_row", F.monotonically_increasing_id()))
        ex = texts.select("_row", F.posexplode("_all").alias("_pos", "_tok"))
        ex = ex.join(vocab.select(F.col("token").alias("_tok")), "_tok", "left_semi")
        src = ex.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_tok"))),
                                                lambda s: s["_tok"]).alias(tokens))
    p = src.select(F.posexplode(tokens).alias("i", "center"), F.col(tokens).alias("_a"))
    ctx = F.filter(F.transform(F.sequence(F.greatest(F.col("i") - window, F.lit(0)),
                                          F.least(F.col("i") + window, F.size("_a") - 1)),
                               lambda j: F.when(j != F.col("i"), F.element_at("_a", j + 1))),
                   lambda x: x.isNotNull())
    return p.select("center", F.explode(ctx).alias("context"))


def cbow_windows(df: DataFrame, tokens: str, window: int) -> DataFrame:
    """``(context array, target)`` for every position with a full window on both sides."""
    p = df.select(F.posexplode(tokens).alias("i", "target"), F.col(tokens).alias("_a"))
    p = p.where((F.col("i") >= window) & (F.col("i") + window < F.size("_a")))
    ctx = F.concat(F.slice("_a", F.col("i") - window + 1, window), F.slice("_a", F.col("i") + 2, window))
    return p.select(ctx.alias("context"), "target")


# ------------------------------------------------------------------ BLEU

def clipped_matches(pairs: DataFrame, key: str, ref: str, hyp: str, max_n: int = 4, strip_bpe: bool = True) -> DataFrame:
    """``n, m, t, u``: clipped matches, n-grams of ``hyp`` and of ``ref`` per order and task; rows of one key count as one text.

    Only the texts are shuffled, by ``key``: the rows of a key lie together in a sorted partition, where their n-grams
    are counted key by key.
    """
    def toks(c):
        s = F.col(c)
        if strip_bpe:
            s = F.regexp_replace(s, "@@ ", "")
        return F.coalesce(F.filter(F.split(F.trim(s), r"\s+"), lambda x: x != ""), F.array().cast("array<string>"))

    def grams(texts: list[list[str]]) -> list[Counter]:
        """The n-grams of texts, counted by order."""
        return [Counter(g for t in texts for g in zip(*(t[i:] for i in range(n)))) for n in range(1, max_n + 1)]

    def count(batches):
        sums = np.zeros((max_n, 3), np.int64)

        def add(refs: list[list[str]], hyps: list[list[str]]) -> None:
            for of_order, r, h in zip(sums, grams(refs), grams(hyps), strict=True):
                of_order += sum((r & h).values()), h.total(), r.total()

        last, refs, hyps = None, [], []
        for batch in batches:
            for key, r, h in zip(batch["_id"], batch["_r"], batch["_h"], strict=True):
                if key.as_py() != last:
                    add(refs, hyps)
                    last, refs, hyps = key.as_py(), [], []
                refs.append(r.as_py())
                hyps.append(h.as_py())
        add(refs, hyps)
        yield pa.RecordBatch.from_arrays([pa.array(range(1, max_n + 1), pa.int32()), *map(pa.array, sums.T)], ["n", "m", "t", "u"])

    d = pairs.select(F.col(key).alias("_id"), F.col(ref).alias("_ref"), F.col(hyp).alias("_hyp"))
    d = d.repartition("_id").sortWithinPartitions("_id").select("_id", toks("_ref").alias("_r"), toks("_hyp").alias("_h"))
    return d.mapInArrow(count, "n int, m bigint, t bigint, u bigint")


def corpus_bleu(pairs: DataFrame, key: str, ref: str, hyp: str, max_n: int = 4, strip_bpe: bool = True) -> DataFrame:
    """Corpus BLEU-4 x 100; each n-gram precision ``m/t`` is smoothed to ``(m + 1)/t``
    (``t`` at least 1), brevity penalty from total lengths, 0 when no unigram matches.

    The n-grams are counted by :func:`clipped_matches`, whose rows add up to one per order.
    """
    counts = clipped_matches(pairs, key, ref, hyp, max_n, strip_bpe)
    rows = {x["n"]: x for x in counts.groupBy("n").agg(*[F.sum(c).alias(c) for c in "mtu"]).collect()}  # a row per order
    num = [float(rows[n]["m"]) if n in rows else 0.0 for n in range(1, max_n + 1)]
    den = [max(1.0, float(rows[n]["t"]) if n in rows else 0.0) for n in range(1, max_n + 1)]
    lens = {"c": rows[1]["t"], "r": rows[1]["u"]} if 1 in rows else {"c": 0, "r": 0}
    c, r = float(lens["c"] or 0), float(lens["r"] or 0)
    bp = 1.0 if c > r else (math.exp(1 - r / c) if c > 0 else 0.0)
    if num[0] == 0:
        bleu = 0.0
    else:
        bleu = 100.0 * bp * math.exp(sum(math.log((mn + 1.0) / md) for mn, md in zip(num, den)) / max_n)
    return pairs.sparkSession.createDataFrame(
        [(bleu, bp, c, r, *num, *den)],
        "bleu double, bp double, hyp_len double, ref_len double, "
        + ", ".join(f"match{n} double" for n in range(1, max_n + 1)) + ", "
        + ", ".join(f"total{n} double" for n in range(1, max_n + 1)))


# ------------------------------------------------------------------ occlusion

def occlusion_variants(df: DataFrame, key: str, tokens: str, mask: str = "UNK") -> DataFrame:
    """One row per (document, position) with that token replaced by ``mask``."""
    p = df.select(key, F.col(tokens).alias("_a"), F.posexplode(tokens).alias("pos", "token"))
    masked = F.transform("_a", lambda x, i: F.when(i == F.col("pos"), F.lit(mask)).otherwise(x))
    return p.select(key, "pos", "token", masked.alias(tokens))


def occlusion_of_sums(df: DataFrame, key: str, tokens: str, terms: DataFrame, mask: str = "UNK") -> DataFrame:
    """T24 for a score that is a sum over the tokens: the weight of a position is its token's own term less the mask's,
    one row per position.  ``terms``: ``(token, term)``; a token without one adds nothing."""
    own = df.select(key, F.posexplode(tokens).alias("pos", "token"))
    masked = terms.where(F.col("token") == mask).agg(F.coalesce(F.first("term"), F.lit(0.0))).first()[0]
    found = own.join(terms.select("token", "term"), "token", "left")
    return found.select(key, "pos", "token", (F.coalesce("term", F.lit(0.0)) - F.lit(masked)).alias("weight"))


def occlusion_weights(df: DataFrame, key: str, tokens: str, score_fn, mask: str = "UNK") -> DataFrame:
    """``weight(pos) = score(original) - score(with pos masked)`` for any batch scorer
    ``score_fn(DataFrame[key, tokens, ...]) -> DataFrame[key, ..., score]``."""
    base = score_fn(df.select(key, tokens)).select(key, F.col("score").alias("_base"))
    var = occlusion_variants(df, key, tokens, mask).withColumn("_vid", F.struct(key, "pos"))
    scored = score_fn(var.select(F.col("_vid").alias(key), tokens)).select(
        F.col(f"{key}.{key}").alias(key), F.col(f"{key}.pos").alias("pos"), F.col("score").alias("_masked"))
    return var.select(key, "pos", "token").join(scored, [key, "pos"]).join(base, key).select(
        key, "pos", "token", (F.col("_base") - F.col("_masked")).alias("weight"))
