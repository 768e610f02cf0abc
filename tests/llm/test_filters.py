"""Decontamination, exact and near deduplication, secrets and packing against plain versions."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from tokenizers import Tokenizer

from roadpulse.llm import decontaminate, exact_dedup, packing, secret_scan, simhash
from roadpulse.llm.components import components

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return (t or "").encode().translate(simhash._LOWER).decode()


def brute_contamination(rows, items):
    out = []
    for i, t in rows:
        w, hit, own = ALNUM.findall(lower(t)), set(), set()
        for item, text in items:
            x = ALNUM.findall(lower(text))
            n = min(10, len(x))
            wins = {tuple(x[a:a + n]) for a in range(len(x) - n + 1)} if n else set()
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in wins:
                    hit |= set(range(a, a + n))
                    own.add(str(item))
        out.append((i, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def test_contamination(spark, docs, corpus, none, nameless):
    passage = corpus[-5][1].split("\n")[1]
    items = [(1, passage), (2, "iota1"), (3, corpus[7][1]), (10, None), (11, ""), (12, "?!"), (1, passage), (4, "Beta3 GAMMA4"),
             (5, " ".join(passage.upper().split(" ")[20:45]))]
    bench = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, doc_id int")
    want = brute_contamination(corpus, [x for x in items])
    assert Counter(map(tuple, decontaminate.contamination(docs, bench).collect())) == want
    many = decontaminate.find_contamination(docs, bench, block_words=40)
    assert sorted((r.doc_id, r.n_words, sum(h.end - h.start for h in r.hits), len(r["items"])) for r in many.collect()) \
        == sorted(k[:4] for k in want.elements())
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.contamination(nameless, bench).count() == 3
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[-1])


def test_contamination_is_the_same_in_blocks(spark):
    """Repeated and null ids of documents and items, over one block and over many."""
    window = "one two three four five six seven eight nine ten"
    rows = [(7, f"{window} and more"), (7, "nothing at all"), (7, f"{window} and more"), (None, "nothing here"), (None, f"x {window.upper()}"),
            (None, None), (8, "short item only"), (9, ""), (9, f"{window} eleven twelve short item")]
    items = [(1, f"{window} eleven"), (None, window), (None, "short item"), (2, "short item"), (2, "only"), (3, None), (4, " ?"), (1, f"{window} eleven")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, bad_key int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination(rows, [("null" if i is None else i, t) for i, t in items])
    assert sum(want.values()) == len(rows) and {k[3] for k in want} == {0, 2, 3}
    for block_words in (decontaminate.BLOCK_WORDS, 8, 3):
        got = decontaminate.find_contamination(docs, bench, block_words)
        assert Counter((r.doc_id, r.n_words, sum(h.end - h.start for h in r.hits), len(r["items"]),
                        hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.hits)) for r in got.collect()) == want
        kept = decontaminate.drop_contaminated(docs, bench, block_words)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(7, "nothing at all"), (0, "nothing here"), (0, ""), (9, "")])
    assert Counter(map(tuple, decontaminate.contamination(docs, bench).collect())) == want


def test_exact_copies(docs, corpus, none, nameless):
    groups = defaultdict(list)
    for i, t in corpus:
        groups[t or ""].append(i)
    want = sorted((i, max(g), len(g), i == max(g)) for t, g in groups.items() for i in g)
    got = exact_dedup.find_copies(docs, buckets=4)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == want
    assert exact_dedup.find_copies(none, buckets=4).count() == 0
    assert sorted(map(str, (r.keep_id for r in exact_dedup.find_copies(nameless, buckets=4).collect()))) == ["3", "3", "None"]
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == sum(k[3] for k in want)


def test_digest_index_remembers(spark, tmp_path):
    day = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), buckets=4)
    index.ingest(day((1, "a"), (2, "a"), (3, "b"))).collect()
    index.close()
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), buckets=4)
    got = {(r.doc_id, r.keep_id, r.kept) for r in index.ingest(day((9, "a"), (8, "c"), (7, "c"))).collect()}
    assert got == {(9, 2, False), (8, 8, True), (7, 8, False)}
    assert index.rows().count() == 3


def test_append_joins_on_buckets(spark, tmp_path):
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path / "index"), buckets=8)
    index.ingest(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    new = spark.range(5).selectExpr("sha2(string(id), 256) text_sha256").hint("merge")
    plan = new.join(index.rows().hint("merge"), "text_sha256", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1


def brute_fingerprint(t):
    w = re.findall("[^\x20\x09-\x0d]+", lower(t))
    s = [" ".join(w[a:a + 4]) for a in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    near = [(i, f) for i, f in pairs]
    comp = {i: i for i, _ in near}
    while True:
        new = {i: min(comp[j] for j, g in near if (f ^ g).bit_count() <= 4) for i, f in near}
        if new == comp:
            return comp
        comp = new


def test_simhash(docs, corpus, none, nameless):
    prints = [(i, brute_fingerprint(t)) for i, t in corpus]
    comp = brute_components(prints)
    want = sorted((i, f"{f:016x}", comp[i]) for i, f in prints)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert len(set(comp.values())) < len(set(prints))
    assert simhash.near_duplicates(none).count() == 0
    assert {r.component_id for r in simhash.near_duplicates(nameless).collect()} == {3, None}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in corpus if comp[i] == i)


def test_long_postings_link_over_midpoints(spark):
    rng = np.random.default_rng(3)
    fps = [0x1234_5678_9ABC_DEF0]
    for _ in range(60):
        f = int(rng.choice(np.array(fps, np.uint64)))
        for b in rng.choice(64, 3, replace=False):
            f ^= 1 << int(b)
        fps.append(f)
    fps += [int(x) for x in rng.integers(0, 1 << 63, 20, dtype=np.uint64)]
    fps = list(dict.fromkeys(fps))
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    signed = [(int(np.uint64(f).view(np.int64)), f) for f in fps]
    comp = brute_components(signed)
    for least in (1 << 16, 5):
        roots = {r.node: r.root for r in components(simhash.link(frame, long_posting=least)).collect()}
        same = defaultdict(set)
        for s, _ in signed:
            same[roots.get(s, s)].add(s)
        want = defaultdict(set)
        for s, _ in signed:
            want[comp[s]].add(s)
        assert sorted(map(sorted, same.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_spans(t):
    t, out = t or "", []
    for n, (kind, p) in enumerate((
            ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
            ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"))):
        for m in re.finditer(p, t):
            if kind == "assign" and len(m[2]) >= 6 or kind == "access" and len(m[0]) >= 20 or kind == "hex" and len(m[0]) >= 24:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_secrets(spark, none, nameless, corpus):
    key = "deadbeef" * 4
    texts = [t for _, t in corpus] + [
        f"é😀 token = \"{key}\"; API_KEY:abc.def-12 secret=short PassWd='x=y/z+1' token=token=abcdefg", f"AKIA{'A' * 15} AKIA{'B' * 16}!",
        key * 50 + "g" + key, "password:" + "a" * 5, "key" * 3000 + " apikey=ABCDEFG " + "z" * 50_000, "ghp_" + "a1" * 20,
        "-----BEGIN RSA PRIVATE KEY-----"]
    frame = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_hex int")
    for r in secret_scan.secret_counts(frame).collect():
        base = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")]
        assert set(base) <= set(r.spans.split(",")) | {""}
    assert secret_scan.secret_counts(none).count() == 0 and secret_scan.secret_counts(nameless).count() == 3


def test_trigram_queries():
    query = {r.kind: secret_scan.trigram_query(r.pattern) for r in secret_scan.RULES}
    assert query["hex"] == [] and query["access"] == [frozenset({frozenset({"aki", "kia"})})]
    assert frozenset({"tok", "oke", "ken"}) in query["assign"][0]
    assert secret_scan.trigram_query("(abc)?de") == [] and secret_scan.trigram_query("x(abcd|efg)+y") == []
    assert secret_scan.trigram_query("[ab]cde") == [frozenset({frozenset({"acd", "cde"}), frozenset({"bcd", "cde"})})]


def check_packing(rows, got, group_tokens=packing.GROUP_TOKENS):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, ids[i]))
        for r in own:
            assert zlib.crc32(np.array(ids[i][0][r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            assert r.doc_tokens == len(ids[i][0])
        if len(ids[i]) == 1:
            own.sort(key=lambda r: r.start)
            assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
    for spans in seqs.values():
        spans.sort()
        assert [a for a, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1])
    sizes = [sum(n for _, n in s) for s in seqs.values()]
    assert max(sizes) <= 4096
    return sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes), sum(sizes), len({r.step_group for r in got})


def test_packing(docs, corpus, none, nameless):
    path = public_tokenizers.path("word_bpe_49k.json")
    wasted, _, groups = check_packing(corpus, packing.pack(docs, path).collect())
    assert wasted <= 4096 * groups
    small = packing.pack(docs.coalesce(1), path, group_tokens=8192).collect()
    wasted, tokens, groups = check_packing(corpus, small)
    assert groups == -(-tokens // 8192) and wasted <= 4096 * 1
    assert packing.pack(none, path).count() == 0
    assert packing.pack(nameless, path).agg({"length": "sum"}).first()[0] == 6 + 1 + 6


def test_tiers_have_windows_of_their_own():
    rng = np.random.default_rng(5)
    sizes = [int(x) for x in np.exp(rng.uniform(0, 9.5, 700))]
    packed = packing.pack_pool(sizes)
    filled = [sum(n for _, _, n in pieces) for _, pieces in packed]
    assert sum(filled) == sum(sizes) and {t for t, _ in packed} == set(packing.TIERS)
    assert sum(n != t for (t, _), n in zip(packed, filled)) <= 1  # one sequence at most is not full
    opened = [(t, packing.tier_of(pieces[0][2])) for t, pieces in packed]
    assert sum(t != own for t, own in opened) <= len(packing.TIERS)  # by a rest of its tier, but for the last ones
    seen = defaultdict(int)
    for _, pieces in packed:
        for doc, _, n in pieces:
            seen[doc] += n
    assert [seen[i] for i in range(len(sizes))] == sizes


def test_step_groups_are_balanced():
    rng = np.random.default_rng(6)
    tiers = [int(rng.choice(packing.TIERS)) for _ in range(900)]
    group = packing.step_groups(tiers, tiers, 4)
    loads = [sum(t for t, g in zip(tiers, group) if g == k) for k in range(4)]
    assert max(loads) - min(loads) <= min(packing.TIERS)
    for tier in packing.TIERS:
        own = [sum(t == tier and g == k for t, g in zip(tiers, group)) for k in range(4)]
        assert max(own) - min(own) <= 32 if tier == 256 else max(own) - min(own) <= 2


def test_words_are_encoded_as_in_the_whole_text(spark, data):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    enc = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    texts += ["a\n\n  b\t c", "x\x1cy\u0085z", "é ́x", "ΟΔΟΣ ΣΑΣ.", "it's I'LL 'S", "<|startoftext|>a <|endoftext|>", " lead", "ﬁ İ ǅ",
              " ".join(chr(c) + "a" + chr(c) for c in range(0x21, 0x250)), "naïve ÿÿ ×÷ ß. garçon's e\u0301t"]
    column = pa.array(["cut off", *texts, "end"]).slice(1, len(texts))
    for t, ids in zip(texts, enc.encode(column), strict=True):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t[:80]
