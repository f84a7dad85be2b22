"""Collocations, hard negatives and toxicity scores against plain references and held-out labels."""

import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.llm import collocations, hard_negatives, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- 11

def collocation_rows(docs, longest=3, least=10, covered=50, top=2000):
    """Plain reference on (text, lang) pairs."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[(lang or "und", *w[i : i + k])] += 1
    frequent = {g: a for g, a in f.items() if a >= least and len(g) > 2}
    drop = {g[0:1] + part for g, a in frequent.items() for k in range(2, len(g) - 1) for i in range(1, len(g) - k + 1)
            if 100 * a >= covered * f[g[0:1] + (part := g[i : i + k])]}
    out = []
    for lang in {g[0] for g in frequent}:
        rows = []
        for g, a in frequent.items():
            if g[0] != lang or g in drop:
                continue
            score, _, le, r = min((10**6 * a * a // (f[g[: 1 + k]] * f[(lang, *g[1 + k :])]), k, f[g[: 1 + k]], f[(lang, *g[1 + k :])]) for k in range(1, len(g) - 1))
            rows.append((-score, -a, " ".join(g[1:]).encode(), le, r))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def mined(docs, **given):
    return sorted(tuple(r) for r in collocations.collocations(docs, **given).collect())


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(5)
    words = ["a", "b", "new", "york", "city", "The", "it's", "é", "x\x00y", "hot"]
    texts = [None, "", " \t", "...", "a" * 3000, "hot " * 900, "new york city " * 200, "a\x0bb\x0cc d;e"]
    for _ in range(250):
        text = ""
        for _ in range(rng.randint(1, 40)):
            text += rng.choice(["new york", "new york city", rng.choice(words), rng.choice(words)]) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ", "])
        texts.append(text)
    return texts + rng.choices(texts, k=30)


@pytest.mark.parametrize("given", [{}, {"longest": 4, "least": 5, "covered_percent": 80}, {"longest": 2, "least": 3, "top": 7}])
def test_collocations(make_docs, speech, given):
    docs = make_docs(speech, 5)
    pairs = [(t, ["en", "de", None][i % 3]) for i, t in enumerate(speech)]
    plain = {"longest": "longest", "least": "least", "covered_percent": "covered", "top": "top"}
    assert mined(docs, bits=12, **given) == collocation_rows(pairs, **{plain[k]: v for k, v in given.items()})


def test_collocations_of_many_partitions(make_docs, speech):
    """Partitions of any number give one result; n-grams of a group lie across partition borders."""
    pairs = [(t, ["en", "de", None][i % 3]) for i, t in enumerate(speech)]
    spark = make_docs(["x"]).sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert mined(make_docs(speech, 7), least=2, bits=20) == collocation_rows(pairs, least=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_chunks_and_stretches_hold_every_word(speech):
    assert list(collocations.stretches("a b. c d. e", 3)) == ["a b.", " c d.", " e"]
    assert "".join(collocations.stretches("x" * 50, 4)) == "x" * 50
    batch = pa.RecordBatch.from_pydict({"text": [t or "" for t in speech], "lang": ["en", "de"] * (len(speech) // 2) + ["en"] * (len(speech) % 2)})
    counts = []
    for size in (10, 10**6):
        found = Counter()
        for chunk in collocations.chunks(iter([batch]), size):
            names = list(chunk.numbers)
            stream = chunk.stream()
            (columns), n = collocations.counted([stream[at + k] for at in [collocations.grams(stream, 2)] for k in range(2)])
            found.update({(chunk.lang, names[a], names[b]): int(k) for a, b, k in zip(*columns, n, strict=True)})
        counts.append(found)
    assert counts[0] == counts[1] and counts[0]


def test_collocations_count_whole_long_texts(make_docs):
    long = "one two three. " * 100_000  # longer than a stretch
    rows = mined(make_docs([long, "one two"]))
    assert rows == [("en", 1, "one two three", 100_000, 100_000, 100_000, 300_000, 10**6)]


def test_collocations_of_empty_tables(make_docs):
    assert mined(make_docs([]).limit(0)) == []
    assert mined(make_docs([None, "", "?!"])) == []


def test_cut_score_passes_64_bits():
    a = 10**15
    assert collocations.cut_score(a, a + 1, a + 3) == 10**6 * a * a // ((a + 1) * (a + 3)) == 999_999


# ---------------------------------------------------------------- 12

def negative_rows(rows, positives=5, negatives=3):
    """Plain reference on (vec_id, vector, label) rows with distinct ids."""
    clean = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        clean.append((i, [int(np.floor(256 * float(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, v, label in clean:
        if i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, k) for j, w, k in clean if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(hard, 1)]
    return sorted(out)


VECTORS = "label int, vec_id long, embedding array<float>, _v string, _c int, rank int, score long, _label int"


def vector_table(spark, rows, parts=3):
    wide = [(label, i, v, "x", 1, 2, 3, 4) for i, v, label in rows]
    return spark.createDataFrame(wide, VECTORS).repartition(parts)


def test_hard_negatives(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.choice([-1, -0.5, 0, 0.25, 0.5, 1], 6)], int(rng.integers(0, 4))) for i in range(400)]  # many ties
    rows += [(400, None, 1), (450, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (401, [float("nan")] * 6, 1), (402, [float("inf")] * 6, 2), (403, [1.0] * 6, None),
             (None, [1.0] * 6, 1), (500, [0.0] * 6, 1), (550, [], 2), (405, [0.5], 2), (600, [-1.0] * 6, 9), (-50, [1.0] * 6, 3)]
    expected = negative_rows(rows)
    assert expected
    df = vector_table(spark, rows)
    for cells in ({}, {"cell_rows": 60, "cell_anchors": 3}):
        assert sorted(tuple(r) for r in hard_negatives.mine(df, **cells).collect()) == expected
    assert hard_negatives.mine(df.limit(0)).count() == 0
    # rows that repeat as a whole change nothing
    assert sorted(tuple(r) for r in hard_negatives.mine(vector_table(spark, rows + rows[:60])).collect()) == expected


def test_hard_negatives_of_one_label(spark):
    rows = [(i, [1.0, i / 100], 1) for i in range(1, 200) if i % 7]
    assert hard_negatives.mine(vector_table(spark, rows)).count() == 0


@pytest.mark.parametrize("reach", [3, 300, 10**6, 10**9, 10**12, 10**25])
def test_packed_products_are_exact(reach):
    """Fields of 4, 8 and more bytes: no carry crosses, signs come out right."""
    rng = random.Random(reach)
    rows = [[rng.randint(-reach, reach) for _ in range(9)] for _ in range(40)] + [[reach] * 9, [-reach] * 9, [0] * 9, []]
    pack = hard_negatives.Pack(rows, reach)
    for anchor in (rows[0], [reach] * 9, [-reach] * 9, [1], [reach] * 11):
        exact = [sum(x * y for x, y in zip(anchor, r, strict=False)) for r in rows]
        assert pack.scores(anchor).tolist() == [min(max(x, -(2**63)), 2**63 - 1) for x in exact]


# ---------------------------------------------------------------- 13

def auc(scores, labels):
    pairs = sorted(zip(scores, labels, strict=True))
    ranks, i = {}, 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        ranks[pairs[i][0]] = (i + j + 1) / 2
        i = j
    ones = sum(labels)
    return (sum(ranks[s] for s, y in pairs if y) - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGER}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert auc(*zip(*held, strict=True)) >= 0.8
    assert np.mean([(s >= 0.5) == y for s, y in held]) >= 0.92
    # labels of the held-out rows do not move a score
    turned = labels.withColumn("toxic", brute_flip(labels))
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, turned).collect()}
    assert again == {i: r.score for i, r in got.items()}


def brute_flip(labels):
    from pyspark.sql import functions as F

    held = F.crc32(labels["doc_id"].cast("string")) % 5 == 0
    return F.when(held, 1 - labels["toxic"]).otherwise(labels["toxic"])


def test_toxicity_of_awkward_rows(spark, make_docs):
    texts = [None, "", "you idiot", "YOU IDIOT!!", "y o u i d i o t", "fine words here " * 9000] + ["you are an id1ot and scum", "a calm day by the sea"] * 40
    docs = make_docs(texts)
    labels = spark.createDataFrame([(i, int(i >= 6 and i % 2 == 0), "x") for i in range(len(texts))] + [(3, None, "x"), (None, 1, "x"), (10**9, 1, "x")],
                                   "doc_id long, toxic int, features string")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[6] > 0.5 > scores[7]
    twice = toxicity.toxicity(docs.union(docs), labels).collect()
    assert len(twice) == 2 * len(texts)
    # nothing to learn from
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.predicted for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_toxicity_features():
    table = toxicity.TokenTable({"lousy": 5.0, "^grub": 4.5})
    f = dict(zip(toxicity.FEATURES, table.features("You are a lousy grubber, you 1d10t! THIS IS !! soooo l o u s y"), strict=True))
    assert f["second_person"] > 0 and f["near_second_person"] > 0 and f["second_person_distance"] == 1
    assert f["obfuscated_hits"] > 0 and f["stretched"] > 0 and f["spelled_out"] > 0 and f["capital_words"] > 0 and f["repeated_marks"] > 0
    assert np.expm1(f["lexicon"]) == pytest.approx(3)
    calm = dict(zip(toxicity.FEATURES, table.features("a calm day"), strict=True))
    assert calm["lexicon"] == calm["near_second_person"] == 0 and calm["second_person_distance"] == toxicity.FAR
    assert not table.features("").sum() - toxicity.FAR
