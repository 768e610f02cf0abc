"""Toxicity, line templates, substrings, page text and token counts against plain versions; the pipeline."""
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, models, normalizers

from pyspark.sql import functions as F

from roadpulse.llm import line_templates, site_style, substrings, token_counts, toxicity
from roadpulse.llm.fm_index import FmIndex, suffix_array

SPACE = re.compile("[^\x20\x09-\x0d]+")


def brute_removed(rows):
    words, first = [SPACE.findall(t or "") for _, t in rows], {}
    for (i, _), w in zip(rows, words):
        for a in range(len(w) - 12):
            first[tuple(w[a:a + 13])] = min(i, first.get(tuple(w[a:a + 13]), i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {b for a in range(len(w) - 12) if first[tuple(w[a:a + 13])] < i for b in range(a, a + 13)}
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_substrings(spark, docs, corpus, none, nameless, monkeypatch):
    assert Counter(map(tuple, substrings.substring_digests(docs).collect())) == brute_removed(corpus)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 900)  # many blocks
    held = substrings.stored(substrings.blocks(docs), "blocks")
    got = substrings.drop_repeated(docs, held)
    assert Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()) == brute_removed(corpus)
    assert substrings.substring_digests(none).count() == 0 and substrings.substring_digests(nameless).count() == 3


def test_heavy_anchors_spread_over_the_shards(spark, monkeypatch):
    rng = np.random.default_rng(3)
    stock = [f"stock{k}" for k in range(9)]
    say = lambda n: [f"w{k}" for k in rng.integers(0, 5000, n)]
    rows = [(i, " ".join(say(12) + stock + say(12))) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + "  " + rows[i + 1][1]) for i in range(0, 60, 2)] + [(2000, None), (2001, ""), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 4000)
    held = substrings.stored(substrings.blocks(docs), "blocks")
    blocks = [substrings.Block(r.doc_id, r.ends, bytes(r.data), 48) for r in held.collect()]
    uneven = {}
    for whole in (8, 1 << 30):  # windows of an anchor dealt out above eight passages, or never
        counts, sent = Counter(), Counter()
        for b in blocks:
            counts.update(dict(zip(b.anchors.tolist(), b.passages_of_anchors().tolist())))
        for b in blocks:
            flags = np.array([1 + (counts[a] > whole) for a in b.anchors.tolist()], np.int8)
            sent.update({s: len(texts) for s, texts in b.passages(flags)[1].items()})
        uneven[whole] = max(sent.values()) * 48 / sum(sent.values())
        got = substrings.drop_repeated(docs, held, whole)
        assert Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()) == brute_removed(rows)
    assert max(counts.values()) > 100  # around a run of the phrase that is the least of its windows in many documents
    assert uneven[8] < 2 < 3 < uneven[1 << 30]  # the fullest shard against the mean


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 300)
    order = suffix_array(text)
    assert sorted(order.tolist()) == list(range(300))
    starts = np.array([i for i in range(296) if (text[i:i + 4] > 0).all()])
    lo, hi = FmIndex(text).matching(text, starts, 4)
    for s, a, b in zip(starts, lo, hi):
        want = [i for i in range(297) if (text[i:i + 4] == text[s:s + 4]).all()]
        assert (b == a == 0 and len(want) == 1) or sorted(order[a:b].tolist()) == want


def test_token_counts(spark, docs, corpus, none, nameless):
    vocabulary = token_counts.piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    whole = Tokenizer(models.Unigram(vocabulary, 0, True))
    whole.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, vocabulary).collect())
    assert got == Counter((i, len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t in corpus)
    counter = token_counts.Counter(vocabulary)
    for t in ["  a  b ", "\n\n", "梦ң͸ x", "é\n ▁▁x ", "a" * 300, "<s> <0x41>   ", " " * 40 + "x" + " " * 17]:
        assert counter.count(t)[0] == len(whole.encode(t, add_special_tokens=False).ids), t
    assert token_counts.count_tokens(none, vocabulary).count() == 0 and token_counts.count_tokens(nameless, vocabulary).count() == 3


def test_line_templates(spark, none, nameless):
    rows = [(i, f"own line {chr(97 + i)}x of text\nuser {i} logged in from host{i}\n\n{'same' if i < 4 else 'other' + chr(97 + i)} words end") for i in range(6)]
    rows += [(10, None), (11, ""), (12, "x\n" * 500)]
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text.split("\n") == ["own line ax of text", ""] and got[5].n_dropped == 1 and got[5].text.endswith("otherf words end")
    assert (got[10].n_lines, got[10].text, got[12].n_dropped) == (1, "", 0)
    assert line_templates.line_digests(none).count() == 0 and line_templates.line_digests(nameless).count() == 3


def lines_left(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, form string, k int")
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_templates.drop_recurring_lines(frame).collect()), key=str)


def test_a_document_counts_once_for_a_template(spark):
    fruit = [f"Item on the list: {x}" for x in ("apple", "pear", "plum")]
    assert lines_left(spark, [(1, "\n".join(fruit)), (2, "other text of its own")]) == [(1, 3, 0, "\n".join(fruit)), (2, 1, 0, "other text of its own")]
    left = lines_left(spark, [(i, f"own{chr(97 + i)}\nItem on the list: {x}") for i, x in enumerate("apple pear plum fig".split())])
    assert left == [(i, 2, 1, f"own{chr(97 + i)}") for i in range(4)]


def test_a_leaf_has_several_templates(spark):
    say = ("opened the door by {}", "closed one window by {}", "started a motor by {}")
    names = "Ann Bob Cid Dan Eve Fay Gus Hal".split()
    rows = [(8 * k + i, f"2024-01-{i + 1:02d} 10:{i}:00 {i} {s.format(n + chr(97 + k))}\n{n}{chr(97 + k)} stays")
            for k, s in enumerate(say) for i, n in enumerate(names)]
    assert lines_left(spark, rows) == sorted(((i, 2, 1, t.split("\n")[1]) for i, t in rows), key=str)


def test_lines_of_one_leaf_that_share_little_stay(spark):
    rows = [(i, f"It was a {a} {b} {c}") for i, (a, b, c) in enumerate(
        zip("red big old new wet dry".split(), "cat dog cow hen fox owl".split(), "ran sat hid fed saw won".split()))]
    assert all(r[2] == 0 for r in lines_left(spark, rows))


def test_repeated_rows_and_long_texts_of_lines(spark):
    same = [(1, "line of mine\nline of yours"), (1, "line of mine\nline of yours"), (1, "line of mine\nother"), (None, "line of mine"), (None, "line of mine")]
    assert lines_left(spark, same) == sorted([(1, 2, 1, "line of yours")] * 2 + [(1, 2, 1, "other"), *[(None, 1, 1, "")] * 2], key=str)
    long = "\n".join(f"word{chr(97 + i % 26)} number {chr(97 + i // 26 % 26)} {'x' * (i // 676)} end" for i in range(20_000))
    rows = [(1, long), (2, long + "\nlast"), (3, "first\n" + long), (4, "")]
    assert lines_left(spark, rows) == [(1, 20_000, 20_000, ""), (2, 20_001, 20_000, "last"), (3, 20_001, 20_000, "first"), (4, 1, 0, "")]


def test_page_text(spark):
    page = ("<!DOCTYPE html><html><head><title>t</title><style>p{a>b}</style></head><body><nav><a>Menu</a></nav><header>Top</header>"
            "<div class='ad'>buy</div><article><h1>A &amp; B</h1><p>one <b>two</b>three<br>four<p>five<div class=share>Share me</div>"
            "<script>var t='</p>'</script><form>x<input></form><ul><li>i<li>j</ul></article><aside>s</aside><footer>&copy; f</footer></body></html>")
    assert site_style.main_text(page) == "A & B one twothree four five i j"
    bare = lambda n: f"<body><div class=top>Same on all</div><div><p>Text number {n} of this site</p></div>"
    rows = [(n, "http://h.example/a", bare(n)) for n in range(8)] + [(20, None, None), (21, "x", ""), (22, "http://h.example/b", "<p <<b>>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in site_style.page_texts(pages).collect()}
    assert got[3] == "Text number 3 of this site" and got[20] == got[21] == "" and len(got) == 11
    assert site_style.page_texts(pages.where("false")).count() == 0


def test_names_are_evidence_only():
    kept = "<p>Main text here.</p>"
    for page in (f"<div class='content with-sidebar'><article>{kept}</article></div>", f"<article class='post comments-open'>{kept}</article>",
                 f"<article><h2 id='related-work'>Main</h2><section id='discussion'><p>text</p></section><p id='legal'>here.</p></article>",
                 f"<main><article><p>Main</p></article><article><p>text here.</p></article></main>",
                 f"<main><h1>Main</h1><article><p>text here.</p></article></main>",
                 f"<article><div class='social-policy'>{kept}</div></article>", f"<form id=page><div class=sidebar><article>{kept}</article></div></form>",
                 f"<div id=content class='has-sidebar no-comments'><main>{kept}</main></div>",
                 f"<main>{kept}<section id=comments><article><p>First!</p></article></section></main>",
                 f"<article>{kept}<div id='comments'><p>Nice</p></div><ul class='share-buttons'><li>x</ul><div class='related-posts'>y</div></article>",
                 f"<article>{kept}</article><aside><article><p>A longer text of another article stands here</p></article></aside>",
                 f"<article>{kept}</article><div class='related'><article><p>A longer text of another article stands here</p></article></div>"):
        assert site_style.main_text(f"<html><body><nav>Menu</nav>{page}<footer>f</footer></body></html>") == "Main text here.", page


def test_layout_speaks_for_a_text_that_is_everywhere(spark):
    """A heading that all pages have stays where its element is laid out anew on each page."""
    def page(n):
        return (f"<body><div class=note>Same on all</div><div class=body><h2>Ingredients</h2>{'<p>part</p>' * (n + 1)}<p>salt {n}</p></div>"
                f"<div class=box><h2>Same</h2><p>box</p></div></body>")
    pages = spark.createDataFrame([(n, "http://h.example/a", page(n)) for n in range(9)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in site_style.page_texts(pages).collect()}
    assert got[2] == "Ingredients part part part salt 2"
    tree = {r.path.rsplit("/", 2)[-2:][0] + "/" + r.path.rsplit("/", 1)[-1]: r for r in site_style.style_tree(
        pages.withColumn("host", F.lit("h"))).collect()}
    assert tree["div.body/h2"].content == 0 and tree["div.body/h2"].presentation == 1 and tree["div.box/h2"].importance == 0


def test_pages_built_with_their_text(spark):
    """Pages of several hosts built at random together with the text that is theirs."""
    rng = np.random.default_rng(11)
    say = lambda n: " ".join("".join(rng.choice(list("abcdeé<&"), 5)) for _ in range(n))
    hidden = ["<nav><ul><li>Home<li>About</ul></nav>", "<aside><h3>More</h3><p>Other</p></aside>", "<div class='ad'>Buy</div>", "<form><label>Mail</label><input></form>",
              "<script>var p='</p>'</script>", "<div class=cookie-banner>We use</div>", "<!-- <p>old</p> -->", "<section id=comments><p>First!</p></section>"]
    rows, want = [], {}
    for i in range(60):
        own, body = [], ""
        for _ in range(rng.integers(1, 9)):
            text = say(rng.integers(1, 12))
            safe = text.replace("&", "&amp;").replace("<", "&lt;")
            kind = rng.integers(0, 5)
            if kind == 4:
                body += hidden[rng.integers(0, len(hidden))]
                continue
            body += [f"<p>{safe}</p>", f"<h2 id=share>{safe}</h2>", f"<ul><li>{safe}</ul>", f"<blockquote><p><b>{safe[:0]}</b>{safe}</blockquote>"][kind]
            own.append(text)
        shell = ["<div class='page with-sidebar'><article>{}</article></div>", "<main>{}</main>", "<article class='post no-share'>{}</article>"][i % 3]
        noise = "".join(hidden[k] for k in rng.integers(0, len(hidden), 3))
        rows.append((i, f"https://h{i % 3}.example/{i}", f"<html><head><title>t</title></head><body><header>Site</header>{noise}{shell.format(body)}{noise}<footer>f</footer></body></html>"))
        want[i] = " ".join(own)
    rows += [(100, rows[0][1], rows[0][2]), (100, rows[0][1], rows[0][2])]
    want[100] = want[0]
    got = site_style.page_texts(spark.createDataFrame([(*r, 7, "x") for r in rows], "page_id long, url string, html string, n_chars int, host string")).collect()
    assert len(got) == 62
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text), rows[r.page_id % 100]


def test_lexicon_catches_misspellings():
    lexicon = toxicity.Lexicon({"worthless": 2.0, "idiot": 1.0, "scum": 1.0}, {"vequ": 1.0})
    assert [lexicon.match(w) for w in ("idiot", "idiott", "idoit", "wortless", "worthlesss", "scun", "vequment", "idea")] == [
        ("idiot", 0), ("idiot", 1), None, ("worthless", 1), ("worthless", 1), None, ("vequ", 0), None]
    plain, quoted = toxicity.features("you idiot", lexicon), toxicity.features('he said "what an idiot" to them', lexicon)
    assert plain[0] > 0 and plain[2] == 0 and quoted[0] == 0 and quoted[2] > 0


def test_toxicity(spark, data, none):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)
    assert toxicity.score(none, toxicity.fit(docs, labels.where("false"))).count() == 0


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = before = spark.read.parquet(f"{data}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data)
        assert docs.columns == before.columns
    kept = {r.doc_id for r in docs.collect()}
    packed = corpus_pipeline.run(spark, data)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept and 0 < len(kept) < before.count()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def test_lexicon_finds_all_terms_within_their_edits():
    rng = np.random.default_rng(5)
    terms = {"".join(rng.choice(list("abc"), n)): float(w) for w, n in enumerate(rng.integers(1, 13, 80), 1)}
    lexicon = toxicity.Lexicon(terms, {})
    for n in rng.integers(1, 15, 1500):
        word = "".join(rng.choice(list("abc"), n))
        near = [(e, -w, t) for t, w in terms.items()
                if t[0] == word[0] and (e := edit_distance(t[1:], word[1:])) <= toxicity.edits_allowed(t)]
        assert lexicon.match(word) == ((min(near)[2], min(near)[0]) if near else None), word


def test_lexicon_finds_terms_with_edits_of_the_first_letter():
    lexicon = toxicity.Lexicon({"idiot": 1.0, "worthles": 2.0}, {}, any_start=True)
    assert [lexicon.match(w) for w in ("udiot", "diot", "xidiot", "xworthle", "wrthlez", "udiat")] == [
        ("idiot", 1), ("idiot", 1), ("idiot", 1), ("worthles", 2), ("worthles", 2), None]
    rng = np.random.default_rng(6)
    terms = {"".join(rng.choice(list("abcd"), n)): float(w) for w, n in enumerate(rng.integers(1, 13, 60), 1)}
    lexicon = toxicity.Lexicon(terms, {}, any_start=True)
    for n in rng.integers(1, 15, 1500):
        word = "".join(rng.choice(list("abcd"), n))
        near = [(e, -w, t) for t, w in terms.items() if (e := edit_distance(t, word)) <= toxicity.edits_allowed(t)]
        assert lexicon.match(word) == ((min(near)[2], min(near)[0]) if near else None), word


def test_toxicity_scores_with_edits_of_the_first_letter(spark):
    model = toxicity.Model({"idiot": 5.0}, {}, (4.0, 4.0, 0.0, 0.0, 0.0, 0.0, 0.0), -2.0)
    docs = spark.createDataFrame([(1, "what an udiot he is"), (2, "what a house it is")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()} == {1: 1, 2: 0}


def test_copies_of_a_page_do_not_lower_its_importance(spark):
    page = lambda text: f"<body><div class=top>Same on all</div><div class=body><p>{text}</p></div>"
    rows = [(n, "http://h.example/a", page("A copied text")) for n in range(300)] \
        + [(300 + n, "http://h.example/a", page(f"Text number {n} of this site")) for n in range(10)] \
        + [(400 + n, "http://k.example/a", page("The only text")) for n in range(6)]
    got = {r.page_id: r.text for r in site_style.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "A copied text" and got[303] == "Text number 3 of this site" and got[400].endswith("The only text")
