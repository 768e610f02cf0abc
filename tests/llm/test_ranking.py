"""Ranked search, language identification and the Merkle manifest against plain versions."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import language, merkle, ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return [x.translate(LOWER) for x in TERM.findall(t or "")]


def brute_search(rows, items, top=50):
    docs = [(i, Counter(x)) for i, t in rows if (x := terms(t))]
    size = [sum(c.values()) for _, c in docs]
    n, words = len(docs), sum(size)
    df = Counter(t for _, c in docs for t in c)
    wanted = defaultdict(set)
    for item, t in items:
        wanted[item] |= set(terms(t))
    out = []
    for item, own in wanted.items():
        found = []
        for (doc, c), m in zip(docs, size):
            m = 50 + 50 * m * n // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in own if t in c)
            if s > 0:
                found.append((-s, doc is None, doc or 0, doc))
        out += [(item, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, "Alpha1 beta2 gamma3 the iota7"), (2, "kappa1 KAPPA1 größe3 niño5 été9 rho0"), (3, None), (4, ""), (5, "?! -"), (6, "nowhere"),
         (1, "delta4"), (None, "nu5 xi6"), (7, " ".join(f"{w}{k}" for w in ("alpha", "beta", "Mu", "pi", "rho") for k in range(40)))]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, doc_id int, score string")


def test_search(spark, docs, corpus, none, nameless, bench):
    want = brute_search(corpus, ITEMS)
    assert rows_of(ranked_search.search(docs, bench)) == want
    assert len({r[0] for r in want}) == 4
    assert rows_of(ranked_search.search(docs, bench, block_chars=20)) == want
    assert rows_of(ranked_search.search(docs, bench, top=3)) == brute_search(corpus, ITEMS, 3)
    assert ranked_search.search(none, bench).count() == 0
    assert ranked_search.search(docs, bench.where("false")).count() == 0
    one = spark.createDataFrame([("a", "one Four")], "item_id string, text string")
    same = [(None, "one two three four five"), (None, None), (3, "one two three four five")]
    assert rows_of(ranked_search.search(nameless, one)) == brute_search(same, [("a", "one Four")])


def test_search_in_small_sets(spark, docs, corpus, bench, monkeypatch):
    """Many sets of documents per task, so that best results are carried on and masks are passed over."""
    import numpy as np
    import pyarrow as pa
    passed = []
    batch = pa.RecordBatch.from_pylist([
        {"doc_id": r.doc_id, "n": r.n, "terms": r.terms, "tf": r.tf}
        for r in ranked_search.postings(docs, ranked_search.item_terms([t for _, t in ITEMS])).collect()],
        schema=pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))]))
    monkeypatch.setattr(ranked_search, "SET_DOCS", 7)
    monkeypatch.setattr(ranked_search, "SET_BITS", 200)
    monkeypatch.setattr(ranked_search, "STEP", 2)
    vocabulary = ranked_search.item_terms([t for _, t in ITEMS])
    n, words = batch.num_rows, sum(batch.column("n").to_pylist())
    df = Counter(t for own in batch.column("terms").to_pylist() for t in own)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[k] + 1))) for k in range(len(vocabulary))], np.int64)
    number = {t: k for k, t in enumerate(vocabulary)}
    scored = ranked_search.DocumentSet.scores
    monkeypatch.setattr(ranked_search.DocumentSet, "scores", lambda self, c: passed.append(len(c)) or scored(self, c))
    own = np.array([number[t] for t in ranked_search.item_terms([ITEMS[0][1], ITEMS[6][1]])])
    best = ranked_search.Best(5)
    for some in ranked_search.document_sets(batch, weights, n, words):
        if some.limit(own, np.array([0]))[0] >= best.least:
            some.search(own, best)
    want = [(d, s) for i, _, d, s in brute_search(corpus, ITEMS, 5) if i == 1]
    assert sorted(zip(best.doc.tolist(), best.score.tolist())) == sorted(want)
    matching = sum(any(number[t] in set(x) for t in number if number[t] in set(own.tolist())) for x in batch.column("terms").to_pylist())
    assert sum(passed) < matching / 2  # most documents are never scored


def test_terms_that_share_a_hash(monkeypatch):
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(ranked_search.Words, "hashes", lambda self: np.zeros(len(self), np.uint64))
    known = ranked_search.Vocabulary([b"ab", b"abc", b"b"])
    w, = ranked_search.words(pa.array(["ab x b abc abd b"]), ranked_search.ALNUM, lower=True)
    word, term = known.find(w)
    assert sorted(zip(word.tolist(), term.tolist())) == [(0, 0), (2, 2), (3, 1), (5, 2)]


def brute_phrases(sample, text):
    at, n = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample and text[at:at + size] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


def test_cross_parsing():
    import numpy as np
    import random
    rng = random.Random(1)
    for _ in range(40):
        sample = bytes(rng.choice(b"abc ") for _ in range(rng.randrange(1, 200)))
        texts = [bytes(rng.choice(b"abcd ") for _ in range(rng.choice([0, 1, 7, 255, 256, 257, 700]))) for _ in range(9)]
        offsets = np.cumsum([0] + [len(t) for t in texts])
        pieces, length, text = language.cut(np.frombuffer(b"".join(texts), np.uint8), offsets)
        got = np.bincount(text, language.Automaton.of(sample).phrases(pieces, length), minlength=9).astype(int).tolist()
        assert got == [sum(brute_phrases(sample, t[a:a + language.PIECE]) for a in range(0, len(t), language.PIECE)) for t in texts]


def test_language(spark, data):
    docs = spark.read.parquet(data.replace("sf0.001", "sf0.01") + "/documents.parquet")
    got = language.identify(docs.withColumn("score", F.lit("x")).withColumn("letters", F.lit(1))).join(
        docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(got) == docs.count() and {r.held_out for r in got} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_of_odd_rows(spark, docs, none):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 ?!", "en"), (4, "the other day they were there with the others", "en"),
            (5, "les autres jours avec les enfants de la rue", "fr"), (6, "the others", None), (None, "les enfants", "xx"), (7, "x" * 100_000, None),
            (8, "ÉTÉ", "fr"), (8, "ÉTÉ", "fr"), (9, "the ß", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = defaultdict(list)
    for r in language.identify(odd).collect():
        got[r.doc_id].append((r.lang_pred, r.score, r.held_out))
    assert {k: v[0][0] for k, v in got.items() if k in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    assert got[1][0][1] == 0 and len(got[8]) == 2 and len(set(got[8])) == 1
    assert got[6][0][0] == "en" and got[None][0][0] == "fr" and got[None][0][2] is False
    assert language.identify(none).count() == 0
    assert {r.lang_pred for r in language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_learning_ignores_the_held_out_fold(spark):
    rows = [(i, f"word{i}", "held" if zlib.crc32(str(i).encode()) % 5 == 0 else "kept") for i in range(60)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("kept",)


def test_sample_is_bounded(spark):
    rows = spark.range(5000).selectExpr("id doc_id", "'some text ' || id text", "if(id % 3 = 0, 'a', 'b') lang")
    got = {r.lang: r["count"] for r in language.sample(rows, most_docs=50).groupBy("lang").count().collect()}
    assert got == {"a": 50, "b": 50}


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][a:a + 3])) for a in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i - i % 3
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + 3])))
        i //= 3
    return out


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    def leaf(r):
        return H("".join(map(field, r)))
    own = defaultdict(list)
    for r in rows:
        own[r[1]].append(((r[0] is not None, r[0] or 0, leaf(r)), r))
    names = sorted(own, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own[s].sort(key=lambda x: x[0])
        trees[s] = tree([x[0][2] for x in own[s]])
    forest = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, r) in enumerate(own[s]):
            p = path(trees[s], i) + path(forest, k)
            h = leaf(r if r[4] is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 2 else (*r[:4], r[4].replace("\n", "")))
            for a, b in p:
                h = H(a + h + b)
            root = forest[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, H("".join(a + b for a, b in p)), h, h == root))
    return sorted(out, key=str)


def manifest_rows(rows, spark, span=merkle.SPAN):
    frame = spark.createDataFrame([(*r, 1, "y") for r in rows],
                                  "doc_id long, source string, lang string, n_chars long, text string, tree int, digest string")
    return sorted(map(tuple, merkle.manifest_digests(frame.repartition(5), span).collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_small_manifests(spark, n):
    rows = [(i, f"s{i % 2}" if n > 4 else "s", None, i, f"text\n{i}") for i in range(n)]
    assert manifest_rows(rows, spark) == (brute_manifest(rows) if rows else [])


def test_manifest(spark, corpus):
    sources = [None, "", "a", "Z", "é", "ü\U0001F600", "￿", *"bcdefghij", "hot"]
    rows = [(i, sources[-1] if k % 2 else sources[k % len(sources)], "en" if k % 3 else None, k if k % 5 else None, t)
            for k, (i, t) in enumerate(corpus)]
    rows += [rows[7], rows[7], (None, "hot", None, None, "x\ny"), (None, None, None, None, None), (None, "hot", "a", 3, "b")]
    got = manifest_rows(rows, spark, span=2)  # builders of nine leaves, so several rounds of them
    assert got == brute_manifest(rows) and {r[-1] for r in got} == {True, False}


def test_proofs_of_the_manifest(spark, docs):
    m = merkle.build(docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text")), span=3)
    for r in merkle.proofs(m).limit(20).collect():
        assert merkle.fold(r.leaf.encode(), [(x.left.encode(), x.right.encode()) for x in r.path]).decode() == m.root


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 26, 27, 28, 81, 100, 244])
def test_positions_in_the_log(n):
    leaves = [f"{i:064d}".encode() for i in range(n)]
    log = merkle.append_log(leaves, merkle.height(n))
    levels = tree([x.decode() for x in leaves])
    assert len(log) == sum(map(len, levels)) == merkle.position(len(levels) - 1, 0, n) + 1
    for level, nodes in enumerate(levels):
        for i, node in enumerate(nodes):
            assert log[merkle.position(level, i, n)].decode() == node
