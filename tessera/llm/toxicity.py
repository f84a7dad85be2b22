"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

*Lexicon.*  A short fixed list of insults, and terms learnt from labelled texts:
whole words and word beginnings (inflected and compounded forms share them) that
toxic texts hold far more often than clean ones.  A training text is measured with
the lexicon of the half of the sample that it is not in, so the trees see hits as
they will be on new texts.

*Features* (:data:`FEATURES`): lexicon densities, insults near a second person,
capitals, punctuation, obfuscated spellings.  A task numbers the distinct tokens
it meets and measures each once; a text is then sums over its token numbers.
Every text is measured whole.

*Model.*  Boosted trees (logistic loss, Newton steps, quantile histograms) on
three quarters of the labelled sample; isotonic regression of the label on the
trees' sum on the remaining quarter makes the score a calibrated probability.
Label, language, source and id are no inputs.

The model is fitted on at most about ``fit_rows`` labelled documents (chosen by a
hash of the id, all of them if there are no more): their texts are measured and
their terms counted by Spark, and only their feature rows, a few MB by that
bound, reach the driver, which grows the trees.  The lexicon holds at most
``lexicon_size`` terms.  Everything else covers all documents.

Defined results: a null text counts as empty and gets a score too; rows that share
an id are scored one by one.  An id with several labels is toxic if any says so;
null labels and labels of absent documents do not count.  Without labelled
documents the score is 0, with labels of one kind only it is their smoothed
rate.  A null id is not held out and has no label.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, written

# Common insults, and second-person pronouns (English, German, French, Spanish).
INSULTS = frozenset(
    """idiot idiots idiotic moron morons moronic stupid dumb dumbass loser losers pathetic worthless disgusting scum trash garbage
    clown clowns imbecile retard retarded jerk creep coward filth filthy vermin bastard bitch asshole fuck fucking shit damn
    dumm dummkopf trottel blödmann arschloch abschaum versager scheiße widerlich
    imbécile crétin débile connard abruti stupide merde ordure
    imbécil estúpido estúpida tonto basura asqueroso mierda cabrón""".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti tus usted ustedes".split())
LOOKALIKES = str.maketrans("@4310!$5|7", "aaeioissit")

FEATURES = (
    "words", "insults", "insult_density", "lexicon", "lexicon_density", "lexicon_weight", "lexicon_strongest", "lexicon_distinct",
    "lexicon_strong", "second_person", "near_second_person", "second_person_distance", "capital_words", "capital_letters",
    "exclamations", "questions", "repeated_marks", "punctuation", "obfuscated", "obfuscated_hits", "stretched", "spelled_out",
    "symbols", "distinct_words",
)

LETTERS = re.compile(r"[^\W\d_]+")
TRIMMED = re.compile(r"^[\W_]+|[\W_]+$")
STRETCHED = re.compile(r"(.)\1{2,}")
MARKS = re.compile(r"[!?]{2,}")
BETWEEN = re.compile(r"[\W_]")
SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Letters of the word beginnings that the lexicon may hold.
BEGINNINGS = (4, 5, 6)
#: Words between an insult and a second person that still count as near.
NEAR = 5
#: Distance reported where there is no insult or no second person.
FAR = 50.0
#: A term this many times (as a logarithm) more frequent in toxic texts is a strong one.
STRONG = 4.0
#: Distinct tokens or terms that a task keeps at a time.
HELD = 200_000


@dataclass(frozen=True)
class Tree:
    """A regression tree as arrays; node ``k`` has the children ``2k + 1`` and ``2k + 2``, a leaf the feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return self.value[node]
            right = x[rows, np.maximum(f, 0)] > self.threshold[node]
            node = np.where(inner, 2 * node + 1 + right, node)


@dataclass(frozen=True)
class BoostedTrees:
    """Log-odds as a start and a sum of trees."""

    start: float
    trees: list[Tree]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t(x) for t in self.trees), np.zeros(len(x)))


def boost(x: np.ndarray, y: np.ndarray, n_trees: int = 120, depth: int = 3, step: float = 0.1, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> BoostedTrees:
    """Gradient-boosted trees for 0/1 labels: each tree is a Newton step, its splits the best of ``bins`` quantiles a feature.

    ``least`` is the smallest sum of second derivatives in a leaf.
    """
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    codes = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(width)], 1)  # code c: above c cuts
    rate = (y.sum() + 0.5) / (n + 1)
    score = np.full(n, math.log(rate / (1 - rate)))
    model = BoostedTrees(float(score[0]), [])
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        gradient, curve = y - p, p * (1 - p)
        size = 2 ** (depth + 1) - 1
        feature, threshold, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        node = np.zeros(n, np.int64)
        for level in range(depth + 1):
            first, count = 2**level - 1, 2**level
            at = np.flatnonzero(node >= first)
            place = node[at] - first
            g, h = (np.bincount(place, w[at], count) for w in (gradient, curve))
            value[first : first + count] = step * g / (h + ridge)
            if level == depth:
                break
            best = np.zeros(count)
            for j in range(width):
                if not len(cuts[j]):
                    continue
                cell = place * bins + codes[at, j]
                gs, hs = (np.bincount(cell, w[at], count * bins).reshape(count, bins).cumsum(1)[:, : len(cuts[j])] for w in (gradient, curve))
                gr, hr = g[:, None] - gs, h[:, None] - hs
                gain = gs**2 / (hs + ridge) + gr**2 / (hr + ridge) - (g**2 / (h + ridge))[:, None]
                gain[(hs < least) | (hr < least)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(count), top] > best + 1e-9
                best = np.where(better, gain[np.arange(count), top], best)
                for k in np.flatnonzero(better):
                    feature[first + k], threshold[first + k] = j, cuts[j][top[k]]
            f = feature[node[at]]
            split = f >= 0
            right = x[at, np.maximum(f, 0)] > threshold[node[at]]
            node[at] = np.where(split, 2 * node[at] + 1 + right, -1)
        tree = Tree(feature, threshold, value)
        model.trees.append(tree)
        score += tree(x)
    return model


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing step fit of ``y`` on ``x`` (pooled adjacent violators), to be interpolated between."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum, count, first x, last x
    values, starts, counts = np.unique(x[order], return_index=True, return_counts=True)
    sums = np.add.reduceat(y[order].astype(np.float64), starts)
    for v, s, c in zip(values.tolist(), sums.tolist(), counts.tolist(), strict=True):
        blocks.append([s, c, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += c
            blocks[-1][3] = last
    return np.array([b[k] for b in blocks for k in (2, 3)]), np.array([b[0] / b[1] for b in blocks for _ in range(2)])


@dataclass(frozen=True)
class ToxicityModel:
    """What one fit leaves: the lexicon, the trees and the knots of the calibration (``None`` where there was nothing to learn)."""

    lexicon: dict[str, float]
    trees: BoostedTrees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), self.base)
        raw = self.trees(x)
        return 1 / (1 + np.exp(-raw)) if self.knots is None else np.interp(raw, *self.knots)


def plain(token: str) -> str:
    """The token in lower case, without marks at its ends."""
    return TRIMMED.sub("", token).lower()


def terms_of(word: str) -> list[str]:
    """Lexicon terms of a word: itself, and its beginnings (marked)."""
    return [word, *("^" + word[:n] for n in BEGINNINGS if len(word) > n)]


class TokenTable:
    """Numbers distinct tokens and keeps a row of attributes for each."""

    # columns of a token's attributes
    INSULT, WEIGHT, YOU, CAPITAL, UPPER, LETTER, EXCLAIM, QUESTION, RUN, PUNCT, OBFUSCATED, HIDDEN, STRETCH, SINGLE, SYMBOL, LENGTH = range(16)

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.rows = np.zeros((1024, 16), np.float32)

    def weight(self, word: str) -> float:
        find = self.lexicon.get
        most = find(word, 0.0)
        for n in BEGINNINGS:
            if len(word) > n:
                most = max(most, find("^" + word[:n], 0.0))
        return most

    def measured(self, token: str) -> tuple:
        bare = token.rstrip(".,;:")
        if bare.isalpha():  # most tokens: letters, and perhaps a stop
            word, stretched = bare.lower(), bool(STRETCHED.search(bare))
            uppers = 0 if bare.islower() else sum(map(str.isupper, bare))
            insult, weight = word in INSULTS, self.weight(word)
            hidden = stretched and not insult and self._hidden(word, weight)
            n, marks = len(bare), len(token) - len(bare)
            return (insult, max(weight, STRONG if insult or hidden else 0.0), word in SECOND_PERSON, n > 1 and uppers == n, uppers, n,
                    0, 0, False, marks, False, hidden, stretched, n == 1, 0, n + marks)
        word = plain(token)
        letters = "".join(LETTERS.findall(token))
        uppers = sum(map(str.isupper, letters))
        insult, weight = word in INSULTS, self.weight(word)
        hidden = not insult and self._hidden(word, weight)
        return (insult, max(weight, STRONG if insult or hidden else 0.0), word in SECOND_PERSON, len(letters) > 1 and uppers == len(letters), uppers, len(letters),
                token.count("!"), token.count("?"), bool(MARKS.search(token)), sum(not c.isalnum() for c in token),
                bool(word) and not word.isalpha() and len(letters) >= 2, hidden, bool(STRETCHED.search(letters)), len(letters) == 1 == len(word),
                len(SYMBOLS.findall(token)), len(token))

    def _hidden(self, word: str, weight: float) -> bool:
        """Is the word an insult or a strong term once its spelling is made plain?"""
        bare = STRETCHED.sub(r"\1", BETWEEN.sub("", word.translate(LOOKALIKES)))
        return bare != word and weight < STRONG and len(bare) > 2 and (bare in INSULTS or self.lexicon.get(bare, 0.0) >= STRONG)

    def ids(self, tokens: list[str]) -> np.ndarray:
        numbers, first = self.numbers, len(self.numbers)
        new = []
        for t in tokens:
            if t not in numbers:
                numbers[t] = len(numbers)
                new.append(self.measured(t))
        while len(numbers) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        if new:
            self.rows[first : len(numbers)] = new
        return np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))

    def features(self, text: str) -> np.ndarray:
        tokens = text.split()
        out = np.zeros(len(FEATURES))
        out[11] = FAR
        n = len(tokens)
        if not n:
            return out
        if len(self.numbers) > HELD:
            self.clear()
        ids = self.ids(tokens)
        found, counts = np.unique(ids, return_counts=True)
        rows = self.rows[found]
        total = counts @ rows
        per = 1000.0 / n
        chars, letters = max(float(total[self.LENGTH]), 1.0), max(float(total[self.LETTER]), 1.0)
        weights = rows[:, self.WEIGHT]
        hit = weights > 0
        hits = float(counts[hit].sum())
        strong = float(counts[weights >= STRONG].sum())
        near, distance = 0, FAR
        if hits and total[self.YOU]:
            at = np.flatnonzero(self.rows[ids, self.WEIGHT] > 0)
            you = np.flatnonzero(self.rows[ids, self.YOU] > 0)
            right = np.searchsorted(you, at)
            gap = np.minimum(np.abs(you[np.minimum(right, len(you) - 1)] - at), np.abs(at - you[np.maximum(right - 1, 0)]))
            near, distance = int((gap <= NEAR).sum()), min(float(gap.min()), FAR)
        spelled = 0
        if total[self.SINGLE] >= 4:
            single = np.concatenate([[0], self.rows[ids, self.SINGLE] > 0, [0]]).astype(np.int8)
            edges = np.flatnonzero(np.diff(single))
            spelled = int((edges[1::2] - edges[::2] >= 4).sum())
        out[:] = (
            math.log1p(n), math.log1p(total[self.INSULT]), total[self.INSULT] * per, math.log1p(hits), hits * per,
            float(counts @ weights) / math.sqrt(n), weights.max(), math.log1p(hit.sum()), math.log1p(strong), total[self.YOU] * per,
            math.log1p(near), distance, total[self.CAPITAL] / n, total[self.UPPER] / letters, 1000 * total[self.EXCLAIM] / chars,
            1000 * total[self.QUESTION] / chars, total[self.RUN] * per, total[self.PUNCT] / chars, total[self.OBFUSCATED] * per,
            math.log1p(total[self.HIDDEN]), total[self.STRETCH] * per, math.log1p(spelled), total[self.SYMBOL] / chars, len(found) / n,
        )
        return out


def measured(sample: DataFrame, lexicons: list[dict[str, float]]) -> DataFrame:
    """``toxic, fold, features`` of the sample's texts, each with the lexicon of the half that it is not in."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicons)  # at most `lexicon_size` terms each

    def run(batches):
        tables = [TokenTable(lexicon) for lexicon in shared.value]
        for batch in slices(batches):
            rows = [tables[1 - half].features(text).tolist() for text, half in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "fold", "features"])

    return sample.select("toxic", "fold", F.coalesce("text", F.lit("")), "half").mapInArrow(run, "toxic int, fold int, features array<double>")


def term_counts(sample: DataFrame) -> DataFrame:
    """``term`` with the toxic and clean texts of each half that hold it, added up in the tasks first."""
    chosen = sample.select(F.coalesce("text", F.lit("")).alias("text"), "toxic", "half")

    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in slices(batches):
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = 2 * half + (not toxic)
                for term in {t for w in {plain(t) for t in text.split()} if len(w) > 2 for t in terms_of(w)}:
                    if (row := counts.get(term)) is None:
                        row = counts[term] = [0, 0, 0, 0]
                    row[place] += 1
                if len(counts) > HELD:
                    yield _counted(counts)
                    counts = {}
        yield _counted(counts)

    found = chosen.mapInArrow(run, "term string, t0 long, c0 long, t1 long, c1 long")
    return found.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("t0", "c0", "t1", "c1")))


def _counted(counts: dict[str, list[int]]) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in counts.values()], pa.int64()) for k in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *columns], ["term", "t0", "c0", "t1", "c1"])


def learn_lexicons(sample: DataFrame, lexicon_size: int, least: int = 3, margin: float = 2.0) -> list[dict[str, float]]:
    """Lexicons of half 0, half 1 and both: terms in ``least`` or more toxic texts whose log-odds exceed ``margin``."""
    sizes = Counter({(r["half"], r["toxic"]): r["count"] for r in sample.groupBy("half", "toxic").count().collect()})
    counts = written(term_counts(sample).where(F.col("t0") + F.col("t1") >= least), "terms")
    lexicons = []
    for halves in ((0,), (1,), (0, 1)):
        toxic, clean = (sum(sizes[(h, k)] for h in halves) for k in (1, 0))
        t, c = (sum((F.col(f"{x}{h}") for h in halves), F.lit(0)) for x in "tc")
        weight = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
        best = counts.select("term", t.alias("t"), weight.alias("weight")).where((F.col("t") >= least) & (F.col("weight") >= margin))
        rows = best.orderBy(F.desc(F.col("weight") * F.sqrt("t")), "term").limit(lexicon_size).collect()
        lexicons.append({r["term"]: r["weight"] for r in rows})
    return lexicons


def labelled(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """``doc_id, text, toxic, fold, half`` of at most about ``fit_rows`` labelled documents that are not held out."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    usable = usable.select("doc_id", "toxic", fold.cast("int").alias("fold")).where("fold <> 0")
    share = min(1.0, fit_rows / max(1, usable.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000))
    sample = usable.where(place < int(share * 1_000_000)).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(2)).cast("int"))
    # about fit_rows short rows at most
    return written(docs.select("doc_id", "text").join(F.broadcast(written(sample, "labelled")), "doc_id"), "toxicity-sample")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 40_000, lexicon_size: int = 4_000, n_trees: int = 120, depth: int = 3, step: float = 0.1) -> ToxicityModel:
    """Lexicon, boosted trees and calibration, from the labels that are not held out."""
    sample = labelled(docs, labels, fit_rows)
    kinds: Counter = Counter()  # rows by (held for calibration, toxic)
    for r in sample.groupBy("fold", "toxic").count().collect():
        kinds[r["fold"] == 4, r["toxic"]] += r["count"]
    toxic, total = sum(n for (_, t), n in kinds.items() if t), sum(kinds.values())
    if not (kinds[False, 0] and kinds[False, 1]):
        return ToxicityModel({}, None, None, (toxic + 1) / (total + 2) if total else 0.0)
    lexicons = learn_lexicons(sample, lexicon_size)
    rows = measured(sample, lexicons[:2]).orderBy("fold", "toxic", "features").toArrow()  # bounded by `fit_rows`
    x = np.array(rows["features"].combine_chunks().flatten()).reshape(-1, len(FEATURES))
    y, held = np.array(rows["toxic"]), np.array(rows["fold"]) == 4
    trees = boost(x[~held], y[~held], n_trees, depth, step)
    calibrated = kinds[True, 0] and kinds[True, 1]
    return ToxicityModel(lexicons[2], trees, isotonic(trees(x[held]), y[held]) if calibrated else None, 0.0)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")
    texts = docs.select("doc_id", held_out, F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the lexicon's bound, and `n_trees` small trees

    def run(batches):
        own = shared.value
        table = TokenTable(own.lexicon)
        for batch in slices(batches):
            if own.trees is None:
                scores = own.scores(np.zeros((batch.num_rows, 0)))
            else:
                scores = own.scores(np.stack([table.features(t) for t in batch.column(2).to_pylist()])) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return texts.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """Fit on the labels that are not held out, score every document."""
    return score(docs, fit(docs, labels, **fitting))
