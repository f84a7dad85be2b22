"""Every operator against a plain reference, on ordinary and on awkward rows."""

import base64
import hashlib
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tessera.llm import (  # noqa: E402
    arrow_tokens, bpe, host_reputation, mixing, queries, repetition, sharding, simhash, substring, trie_dedup, warc,
)

SF = "/root/testdata/sf0.001"


def table(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{name}.parquet' ORDER BY 1").fetchall()


def awkward(seed=1):
    """Empty, white, null, repeated, near-equal, odd white space, long texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(70))
    texts = [None, "", " ", "\n\t", "a", "A  b", "a b\x0c", "a\x1cb\x85c\xa0d 　e", "x " * 300, passage, passage, passage + " end",
             "é" * 5000, "line one here\nline one here\nother line", "# * $ % & | < >" * 9, "it's they'll 12 34  don't\n\n 'x"]
    for _ in range(60):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 90)))
        texts.append(text + " " + passage if rng.random() < 0.3 else text)
    texts += [" ".join(rng.choice(vocabulary) for _ in range(6000))]
    texts += rng.choices(texts, k=20)
    return texts


@pytest.fixture(scope="module")
def texts():
    return awkward() + [t for _, t in table("documents", "doc_id, text")[:120]]


@pytest.fixture(scope="module")
def docs(make_docs, texts):
    return make_docs(texts, 5).cache()


@pytest.fixture(scope="module")
def empty(make_docs):
    return make_docs([]).limit(0)


# ---------------------------------------------------------------- 2

def test_repetition_measures(docs, texts):
    got = {r.doc_id: r for r in repetition.measure(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        base = brute.base_rules(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base, t
        assert r.dup_ngram_chars == max(brute.ngram_chars(t, n) for n in range(5, 11))
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in repetition.filter_repetitive(docs).collect()}
    assert kept == {i for i, r in got.items() if r.kept}
    assert repetition.filter_repetitive(docs).schema == docs.schema


def test_repetition_verdict_by_ngram_characters():
    rng = random.Random(3)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))
    assert repetition.measure_text(clean.encode(), repetition.RepetitionRules())[6]
    six = [f"v{i}" for i in range(6)]
    repeated = []
    for i in range(60):  # six-word runs around ever new words: no eight-word window repeats
        repeated += [*six, f"n{i}"]
    n, _, _, _, repeat, failed, kept, *_ = repetition.measure_text(" ".join(repeated).encode(), repetition.RepetitionRules())
    assert (repeat, failed, kept) == (0, False, False)


# ---------------------------------------------------------------- 4

def test_simhash_components(docs, texts):
    prints = [brute.fingerprint(t) for t in texts]
    want = brute.components(list(range(len(texts))), prints)
    for dense in (64, 1):
        got = {r.doc_id: r for r in simhash.components(docs, dense=dense).collect()}
        assert [got[i].fingerprint for i in range(len(texts))] == [format(p, "016x") for p in prints]
        assert [got[i].component_id for i in range(len(texts))] == want
    kept = sorted(r.doc_id for r in simhash.dedup(docs).collect())
    assert kept == sorted(set(want))


@pytest.mark.parametrize("dense", [1, 8, 10_000])
def test_simhash_links_of_dense_groups(spark, dense):
    """Clusters around few centres: the links' components are those of all pairs, by pairs and by stars."""
    from tessera.llm.common import connected_components

    rng = random.Random(11)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(120):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [(r.a, r.b) for r in simhash.links(frame, dense=dense).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in links)
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.components(signed, prints)
    assert [found.get(p, p) for p in signed] == want


def test_simhash_links_never_broadcast_exploded_rows(spark, tmp_path):
    """Spark sizes the 33 probes of a fingerprint as one row; the plan must not rest on that."""
    spark.range(300).selectExpr("id * 7919 AS fp").write.parquet(f"{tmp_path}/fp")
    frame = spark.read.parquet(f"{tmp_path}/fp")
    depth, under = None, []
    for line in simhash.links(frame, dense=2)._jdf.queryExecution().executedPlan().toString().splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if depth is None and "BroadcastExchange" in line:
            depth = at
        elif depth is not None:
            under.append(line)
    assert not [line for line in under if "Generate" in line]


# ---------------------------------------------------------------- 5

def test_substring(docs, texts):
    want = brute.substring(list(enumerate(texts)))
    got = {r.doc_id: r for r in substring.remove(docs).collect()}
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == want
    assert sum(w[1] for w in want.values()) > 500
    for i, r in got.items():
        assert sum(x.end - x.first for x in r.repeats) == r.n_removed
        assert all(x.end - x.first >= 50 for x in r.repeats)


def test_substring_repeated_and_null_ids(spark):
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(1, body), (1, body), (2, body + " tail"), (None, body), (2, "other " + body)]
    got = [(r.doc_id, r.n_removed) for r in substring.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (1, 0), (2, 60), (None, 0), (2, 60)], key=str)


# ---------------------------------------------------------------- 6

@pytest.mark.parametrize("cells", [1 << 16, 64])
def test_minimax_shards(docs, texts, monkeypatch, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)
    got = {r.doc_id: (r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.assign(docs).collect()}
    assert got == brute.shards(list(enumerate(texts)))


def test_minimax_hot_group(make_docs):
    texts = ["copy " * 30] * 300 + [f"text {i}" for i in range(500)]
    got = {r.doc_id: (r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.assign(make_docs(texts)).collect()}
    assert got == brute.shards(list(enumerate(texts)))


# ---------------------------------------------------------------- 7

def test_arrow_files(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for length, rows in ((2048, 64), (16, 3)):
        got = {r.doc_id: r for r in arrow_tokens.round_trip(docs, P.path("byte_bpe_50k.json"), length=length, rows=rows).collect()}
        start = 0
        for i, t in enumerate(texts):
            ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
            r = got[i]
            assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
            start += len(ids)
    file = arrow_tokens.SequenceFile(got[0].file)
    row = file[got[0].sequence]
    assert len(row[0]) == 16 and row[0].dtype == np.uint16 and not row[0].flags.owndata
    padded = sum(16 - file[i][1].true_count for i in range(len(file)))
    assert padded < 16


def test_units_encode_like_whole_texts():
    from tokenizers import Tokenizer

    own = arrow_tokens.UnitEncoder(P.path("byte_bpe_50k.json"))
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    letters = "ab é\n\t \x1c\x85\xa0　.,!'s12  中\u2028\u200b²ÿ×\u0301Ω_ªtlre"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- 8

@pytest.mark.parametrize("split", [4 << 20, 1000, 37])
def test_warc_round_trip(spark, split):
    rows = table("pages", "page_id, url, html")[:60]
    extra = [None, "", "a" * 999, "é" * 500, "b" * 1000, "c" * 70000]
    rows += [(10_000 + i, None if i % 7 == 0 else "http://x\r\ny", extra[i % 6]) for i in range(40)]
    want = brute.warc([(i, h) for i, _, h in rows])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = warc.round_trip(pages, split_bytes=split).collect()
    assert len(got) == len(rows)
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want


def test_warc_survives_false_magic(tmp_path):
    """A magic inside a payload's compressed bytes, or in stored bytes, is no record."""
    bait = b"\x1f\x8b\x08" * 50
    members = []
    for i in range(30):
        pack = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the bait stands in the file as it is
        body = warc.record(i, "http://a/", bait + bytes([i]), hashlib.sha1(bait).hexdigest(), None, "2024-01-01T00:00:00Z")
        members.append(pack.compress(body) + pack.flush())
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(members))
    size = path.stat().st_size
    for width in (size, 997, 50):
        found = [f["warc-record-id"] for s in range(0, size, width) for _, f, _ in warc.records_in(str(path), size, s, s + width)]
        assert found == [f"<urn:page:{i}>" for i in range(30)]


# ---------------------------------------------------------------- 9

@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 10), (300, 40), (30, 8)])
def test_bpe(docs, texts, chunk, overlap):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(docs, path, P.PATTERN, chunk=chunk, overlap=overlap)
    got = {r.doc_id: r for r in bpe.decode(encoded, path, P.PATTERN, digests=True).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = plain.encode_ordinary(t or "")
        want = len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


# ---------------------------------------------------------------- 10

def test_trie_dedup(docs, texts):
    want = brute.exact(list(enumerate(texts)))
    for budget in (trie_dedup.TRIE_BYTES, 2000):
        got = trie_dedup.assign(docs, budget=budget).collect()
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want
    kept = trie_dedup.dedup(docs, budget=2000)
    assert kept.schema.names == docs.schema.names
    rows = {r.doc_id: r for r in kept.collect()}
    assert set(rows) == {i for i, w in want.items() if w[2]}
    source = {r.doc_id: r for r in docs.collect()}
    assert all(source[i] == r for i, r in rows.items())


def test_trie_holds_smallest_rank():
    rng = random.Random(9)
    trie, want = trie_dedup.PatriciaTrie(1 << 30), {}
    for i in range(3000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9)))
        rank = (rng.randint(0, 5), i)
        trie.insert(key, rank, 1, i)
        low, n = want.get(key, (rank, 0))
        want[key] = (min(low, rank), n + 1)
    assert {k: (tuple(e[0]), e[1]) for k, e in trie.items()} == want
    assert all(e[2] == e[0][1] for _, e in trie.items())


# ---------------------------------------------------------------- 1, 3

def mixing_oracle(rows, tree, percent, epochs, seed=7):
    """Budgets by repeated sharing, draws by sorting."""
    def share(budget, children):  # name -> (weight, capacity)
        taken, open_ = {}, dict(children)
        while open_:
            rest = budget - sum(taken.values())
            total = sum(w for w, _ in open_.values())
            short = [n for n, (w, c) in open_.items() if c * total <= rest * w]
            if not short:
                low = {n: rest * w // total for n, (w, _) in open_.items()}
                order = sorted(open_, key=lambda n: (-(rest * open_[n][0] % total), n))
                for n in order[: rest - sum(low.values())]:
                    low[n] += 1
                return taken | low
            for n in short:
                taken[n] = open_.pop(n)[1]
        return taken

    leaf = {(x.domain, x.lang, x.source): x for x in tree}
    have = {}
    for _, key, n in rows:
        if key in leaf:
            have[key] = have.get(key, 0) + n
    have = {k: n for k, n in have.items() if n}
    cap = lambda *p: sum(n * epochs for k, n in have.items() if k[: len(p)] == p)
    out = {}
    top = share(min(sum(have.values()) * percent // 100, cap()), {k[0]: (leaf[k].domain_weight, cap(k[0])) for k in have})
    for d, b in top.items():
        for lang, b2 in share(b, {k[1]: (leaf[k].lang_weight, cap(d, k[1])) for k in have if k[0] == d}).items():
            low = share(b2, {k[2]: (leaf[k].source_weight, cap(*k)) for k in have if k[:2] == (d, lang)})
            out |= {(d, lang, s): x for s, x in low.items()}
    drawn = {}
    for key, budget in out.items():
        full, rest = divmod(budget, have[key])
        place = 0
        mine = sorted((hashlib.md5(f"{seed}:{full}:{i}".encode()).hexdigest(), str(i), i, n) for i, k, n in rows if k == key)
        for _, _, i, n in mine:
            drawn[i] = full * n + (max(0, min(n, rest - place)) if place < rest else 0)
            place += n
    return out, drawn


def leaf_of(tree, domain, lang, source):
    """The leaf of a row: names that the tree does not hold, and all below them, are the branch of others."""
    path = (domain, lang, source)
    for k in (1, 2, 3):
        if path[:k] not in {(x.domain, x.lang, x.source)[:k] for x in tree}:
            return path[: k - 1] + (mixing.OTHER,) * (4 - k)
    return path


@pytest.mark.parametrize(("percent", "epochs"), [(100, 4), (35, 1), (1000, 3)])
def test_mixing(docs, texts, percent, epochs):
    from pyspark.sql import functions as F

    tree = [mixing.Leaf(d, lang, s, w1, w2, w3) for d, w1, sources in (("a", 5, ("src0", "src1")), ("b", 2, ("src2",)))
            for lang, w2 in (("en", 7), ("de", 3), ("xx", 1)) for s, w3 in zip(sources, (1, 4), strict=False)]
    domain = F.when(F.col("source").isin("src0", "src1"), "a").when(F.col("source") == "src2", "b")
    rows = []
    for r in docs.collect():
        key = leaf_of(tree, {"src0": "a", "src1": "a", "src2": "b"}.get(r.source), r.lang, r.source)
        rows.append((r.doc_id, key, len(brute.words(r.text))))
    assert {(mixing.OTHER,) * 3, ("a", mixing.OTHER, mixing.OTHER)} <= {k for _, k, _ in rows}
    budgets, drawn = mixing_oracle(rows, mixing.with_others(tree), percent, epochs)
    got = {r.doc_id: r for r in mixing.draw(docs, tree, domain, percent, epochs).collect()}
    assert len(got) == len(texts)
    for i, key, n in rows:
        assert (got[i].domain, got[i].lang, got[i].source) == key
        assert got[i].leaf_budget == budgets.get(key, 0)
        assert got[i].drawn_tokens == drawn.get(i, 0), (i, key)
    total = min(sum(n for _, k, n in rows if k in budgets) * percent // 100, sum(n for _, k, n in rows if k in budgets) * epochs)
    assert sum(r.drawn_tokens for r in got.values()) == total
    mixed = mixing.mix(docs, tree, domain, percent, epochs)
    assert mixed.schema.names == docs.schema.names
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times == {i: r.epochs + r.partial for i, r in got.items() if r.epochs + r.partial}


def test_url_rules(spark):
    urls = ["https://www.Example.com/en/1?x", "http://blog.example.com/en/", "http://a.com", "http://a.com/x#y", "HTTP://b.net/es/",
            "http://b.net/fr", None, "no-scheme", "://", "x://h?q://z/", "http://Éa.NET/fr/é"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    outcomes = spark.createDataFrame([(0, None)], "page_id long, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in host_reputation.judge(pages, outcomes).collect()}
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 1: ("blog.example.com", "/en/", "example.com/en/", "block"),
        2: ("a.com", "", None, "allow"), 3: ("a.com", "/x", "com/", "allow"), 4: ("b.net", "/es/", "net/es/", "block"),
        5: ("b.net", "/fr", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"),
        9: ("h", "", None, "allow"), 10: ("Éa.net", "/fr/é", "net/fr/", "block"),
    }


def test_reputation_shrinks(spark):
    """Many bad labels block a host and an unlabelled sibling of a bad domain; one bad label does not."""
    pages, bad, i = [], [], 0
    for host, n, k in (("a.spam.org", 200, 190), ("b.spam.org", 200, 195), ("new.spam.org", 0, 0), ("one.fine.org", 1, 1),
                       ("x.fine.org", 300, 6), ("y.fine.org", 300, 9), ("z.other.org", 200, 4)):
        for j in range(max(n, 1)):
            pages.append((i, f"ftp://{host}/{j}"))
            if n:
                bad.append((i, j < k))
            i += 1
    got = host_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"),
                                spark.createDataFrame(bad, "page_id long, bad boolean"), rules=())
    verdict = {r.host: r.verdict for r in got.collect()}
    assert verdict == {"a.spam.org": "block", "b.spam.org": "block", "new.spam.org": "block", "one.fine.org": "allow",
                       "x.fine.org": "allow", "y.fine.org": "allow", "z.other.org": "allow"}


def test_reputation_of_single_host_domains(spark):
    """Where every host is its own domain, a host's many bad labels still block it."""
    hosts = [(f"h{k}.org", 60, 58 if k < 2 else 3) for k in range(8)]
    rows = [(k * 100 + j, f"ftp://{host}/{j}", j < bad) for k, (host, n, bad) in enumerate(hosts) for j in range(n)]
    got = host_reputation.judge(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"),
                                spark.createDataFrame([(i, b) for i, _, b in rows], "page_id long, bad boolean"), rules=())
    assert {r.host for r in got.collect() if r.verdict == "block"} == {"h0.org", "h1.org"}


def test_reputation_blocks_on_given_pages(spark):
    """The registered query's levels: several hosts a domain; labels that are bad on one host block it alone."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url) for r in pages.collect()]
    host = lambda u: re.sub(r"[/?#].*", "", (u or "").partition("://")[2]).lower()
    hosts = {}
    for i, u in rows:
        hosts.setdefault(host(u), []).append(i)
    assert len({h.rpartition(".")[0].rpartition(".")[2] for h in hosts}) < len(hosts)
    worst = max(hosts, key=lambda h: (len(hosts[h]), h))
    bad = [(i, h == worst or i % 5 == 0) for h, ids in hosts.items() for i in ids * 4]
    got = host_reputation.judge(pages, spark.createDataFrame(bad, "page_id long, bad boolean"), rules=())
    assert {r.host for r in got.collect() if r.verdict == "block"} >= {worst}


def test_page_operators_with_awkward_rows(spark):
    """Null ids, rows that share an id, clashing columns, repeated rows at the largest id of a payload group."""
    long = "<p>" + "x" * 1200
    rows = [(1, "http://a.com/x", long), (1, "http://a.com/x", long), (2, "http://b.net/es/1", long), (5, "http://b.org", long), (5, "http://b.org", long),
            (None, "http://a.org", "short"), (7, None, None), (8, "http://b.org/y", "")]
    names = "page_id long, url string, html string, host string, _id long, bad boolean, n long, rank int"
    pages = spark.createDataFrame([(*r, "h", 9, True, 1, 2) for r in rows], names)
    outcomes = spark.createDataFrame([(1, True, "x"), (None, True, "x"), (5, None, "x"), (5, False, "x")], "page_id long, bad boolean, host string")
    judged = host_reputation.judge(pages, outcomes).collect()
    assert sorted((r.page_id or -1, r.host, r.verdict) for r in judged) == sorted(
        (i or -1, re.sub(r"/.*", "", (u or "").partition("://")[2]), "block" if i == 2 else "allow") for i, u, _ in rows)
    stored = warc.round_trip(pages).collect()
    assert sorted(r.page_id or -1 for r in stored) == sorted(i or -1 for i, _, _ in rows)
    assert {(r.page_id, r.record_type, r.refers_to) for r in stored if r.payload_bytes >= 1000} >= {(1, "revisit", 5), (2, "revisit", 5)}


def test_null_and_shared_ids(spark):
    """Rows whose id is null or shared: every operator returns all of them."""
    from pyspark.sql import functions as F

    path, tree = P.path("byte_bpe_multi_50k.tiktoken"), [mixing.Leaf("a", "en", "s", 1, 1, 1)]
    texts = ["a b c d", "a b c d", "other words", None, "", "x " * 60]
    rows = [(i, t, "en", "s", 1, 2, "r") for i in (1, None) for t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _id long, n long, row string")
    for frame in (simhash.components(df), sharding.assign(df), arrow_tokens.round_trip(df, P.path("byte_bpe_50k.json")),
                  bpe.encode(df, path, P.PATTERN), trie_dedup.assign(df), mixing.draw(df, tree, F.lit("a"))):
        assert sorted((r.doc_id or -1) for r in frame.collect()) == sorted((r[0] or -1) for r in rows)


# ---------------------------------------------------------------- empty tables, SQL

def test_empty_tables(spark, empty):
    from pyspark.sql import functions as F

    path, tree = P.path("byte_bpe_multi_50k.tiktoken"), [mixing.Leaf("a", "en", "src0", 1, 1, 1)]
    for frame in (repetition.measure(empty), repetition.filter_repetitive(empty), simhash.components(empty), simhash.dedup(empty),
                  substring.remove(empty), sharding.assign(empty), arrow_tokens.round_trip(empty, P.path("byte_bpe_50k.json")),
                  bpe.decode(bpe.encode(empty, path, P.PATTERN), path, P.PATTERN), trie_dedup.assign(empty), trie_dedup.dedup(empty),
                  mixing.draw(empty, tree, F.lit("a")), mixing.mix(empty, tree, F.lit("a"))):
        assert frame.collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).collect() == []
    assert host_reputation.judge(pages, spark.createDataFrame([], "page_id long, bad boolean")).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    frame = queries.queries()[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    got = sorted(map(repr, (tuple(r) for r in frame.select(*names).collect())))
    assert got == sorted(map(repr, cursor.fetchall()))


def test_white_space_class_is_the_contracts():
    text = "".join(map(chr, range(0x3100)))
    assert re.findall(r"[^\x20\x09-\x0D]+", text) == [w.decode() for w in text.encode().split()]
