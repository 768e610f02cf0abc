"""Toxicity by a fuzzy lexicon and the context of its hits.

Terms are learned from labelled documents: words, and word beginnings where no
single word carries the sign. The Levenshtein automaton of a text's word runs
over the trie of the terms that share an unedited piece with it, so misspelled
terms are caught within an edit distance that grows with the term's length. Each hit is scored in a window of
words: inside quotation marks or after a reporting cue it is a quotation, next
to an address or further hits it is abuse. A logistic model weighs the sums.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import SLICE_ROWS, doc_texts, map_batches, stored

#: Labelled documents that the model is fitted on, chosen by a hash of their id.
SAMPLE = 20_000
#: Terms of the lexicon at most, the most frequent in toxic documents first.
TERMS = 5_000
#: A term is in at least so many toxic documents, and so many times likelier there.
LEAST_DOCS, LEAST_RATIO = 4, 20.0
STEM = range(4, 9)
#: Words on either side of a hit that make up its context.
WINDOW = 8

_WORD = re.compile(r"[^\W_]+")
_QUOTES = re.compile("[\"“”„«»‹›‘’`]")
#: Cues of reported speech and of address in the four languages.
REPORTING = frozenset("said says say wrote writes quote quoted called calling term word termed reportedly claimed "
                      "sagte sagt schrieb zitat nannte wort dit disait écrit citation mot selon dijo dice escribió cita "
                      "palabra según".split())
ADDRESS = frozenset("you your youre yourself u ur du dich dir dein euch ihr tu te toi vous votre tú ti usted vosotros".split())
FEATURES = ("plain", "fuzzy", "quoted", "addressed", "crowded", "kinds", "share")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


def intact_pieces(terms: Iterable[str], any_start: bool) -> dict[tuple[str, int], list[tuple[int, int, dict[str, list[str]]]]]:
    """(first letter, length) of a word -> (from, to, terms by piece): what such a word holds there if it is near a term.

    ``k`` edits leave one of ``k + 1`` pieces of a term whole. Moved by ``s``
    letters, it has ``|s|`` edits before it and, in a word longer by ``d``,
    ``|d - s|`` after it, together at most ``k``. With ``any_start`` pieces
    begin at the first letter, which may be edited, and the key has no letter.
    """
    found: dict[tuple[str, int], dict[tuple[int, int], dict[str, list[str]]]] = \
        defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for term in terms:
        m, k, at = len(term), edits_allowed(term), 0 if any_start else 1
        cuts = [at + (m - at) * i // (k + 1) for i in range(k + 2)]
        for a, b in zip(cuts, cuts[1:]):
            for d in range(-k, k + 1):
                for s in range(-k, k + 1):
                    if k and abs(s) + abs(d - s) <= k and a + s >= at and b + s <= m + d:
                        found[term[:at], m + d][a + s, b + s][term[a:b]].append(term)
    return {key: [(at, to, dict(pieces)) for (at, to), pieces in spans.items()] for key, spans in found.items()}


def letter_set(word: str) -> int:
    """The letters of a word as bits of their codes; an edit takes at most one letter out of the set and one in."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits


@dataclass
class Lexicon:
    """Terms with weights; those that share a piece with a word form the trie that the word's automaton runs over.

    Without ``any_start`` a word's first letter must be that of the term.
    """
    words: dict[str, float]
    stems: dict[str, float]
    any_start: bool = False

    def __post_init__(self):
        self.pieces = intact_pieces(self.words, self.any_start)
        self.letters = {term: letter_set(term) for term in self.words}
        self.allowed = {term: edits_allowed(term) for term in self.words}
        self.known: dict[str, tuple[str, int] | None] = {}

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance, the likeliest of equally near ones."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > 100_000:
            self.known.clear()
        found = (word, 0) if word in self.words else self._walk(word)
        if found is None or found[1]:
            stem = next((word[:n] for n in range(1, len(word) + 1) if word[:n] in self.stems), None) if self.stems else None
            if stem is not None:
                found = stem, 0
        self.known[word] = found
        return found

    def may_match(self, word: str) -> set[str]:
        """The terms with a piece that ``word`` holds unedited and enough of its letters; no others are within their edits."""
        spans = self.pieces.get(("" if self.any_start else word[:1], len(word)), ())
        terms = {term for at, to, pieces in spans for term in pieces.get(word[at:to], ())}
        if terms:
            own, letters, allowed = letter_set(word), self.letters, self.allowed
            terms = {t for t in terms if (letters[t] & ~own).bit_count() <= allowed[t] and (own & ~letters[t]).bit_count() <= allowed[t]}
        return terms

    def _walk(self, word: str) -> tuple[str, int] | None:
        terms = self.may_match(word)
        if not terms:
            return None
        letters: dict[str, int] = {}
        for i, c in enumerate(word):
            letters[c] = letters.get(c, 0) | 1 << i
        end, found, before = len(word), [], ""
        states = [(1, 3, 7)]  # after each letter of a term: places in the word, as bits, with at most 0, 1 and 2 edits
        for term in sorted(terms):
            shared = 0
            while shared < len(before) and before[shared] == term[shared]:  # no term is the beginning of one before it
                shared += 1
            del states[shared + 1:]
            zero, one, two = states[-1]
            for c in term[shared:]:
                here = letters.get(c, 0)
                none = (zero & here) << 1
                single = (one & here) << 1 | zero | (zero | none) << 1
                zero, one, two = none, single, (two & here) << 1 | one | (one | single) << 1
                states.append((zero, one, two))
            before = term
            e = 0 if zero >> end & 1 else 1 if one >> end & 1 else 2 if two >> end & 1 else 3
            if e <= self.allowed[term]:
                found.append((e, -self.words[term], term))
        if not found:
            return None
        e, _, term = min(found)
        return term, e

    def weight(self, term: str) -> float:
        return self.words.get(term, self.stems.get(term, 0.0))


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The sums of FEATURES over the hits of a text."""
    low = text.lower()
    tokens = _WORD.findall(low)
    of = {w: m for w in set(tokens) if (m := lexicon.match(w))}
    if not of:
        return [0.0] * len(FEATURES)
    spots = [i for i, w in enumerate(tokens) if w in of]
    quotes = [m.start() for m in _QUOTES.finditer(low)]
    spans = [m.span() for m in _WORD.finditer(low)] if quotes else []
    plain = fuzzy = quoted = addressed = crowded = 0.0
    at = set(spots)
    for i in spots:
        term, edits = of[tokens[i]]
        lo, hi = max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1)
        before = after = 0
        if quotes:
            before = bisect_left(quotes, spans[i][0]) - bisect_left(quotes, spans[lo][0])
            after = bisect_left(quotes, spans[hi - 1][1] + 1) - bisect_left(quotes, spans[i][1])
        around = {*tokens[lo:i], *tokens[i + 1:hi]}
        weight = lexicon.weight(term) / (1 + edits)
        if before % 2 and after or around & REPORTING and before + after:
            quoted += weight
        elif edits:
            fuzzy += weight
        else:
            plain += weight
        addressed += weight * bool(around & ADDRESS)
        crowded += weight * (sum(j in at for j in range(lo, hi)) > 1)
    kinds = len({m[0] for m in of.values()})
    return [np.log1p(plain), np.log1p(fuzzy), np.log1p(quoted), np.log1p(addressed), np.log1p(crowded), np.log1p(kinds),
            len(spots) / len(tokens)]


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, stem, toxic documents, clean documents) of the sample."""
    def run(batch: pa.RecordBatch):
        count: dict[bool, Counter] = {False: Counter(), True: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            terms = set(_WORD.findall(text.lower()))
            count[toxic].update({(w, False) for w in terms} | {(w[:n], True) for w in terms for n in STEM if len(w) > n})
        keys = list(count[True].keys() | count[False].keys())
        yield {"term": [k[0] for k in keys], "stem": [k[1] for k in keys], "bad": [count[True][k] for k in keys],
               "good": [count[False][k] for k in keys]}
    return map_batches(sample.select("text", "toxic"), run, "term string, stem boolean, bad long, good long") \
        .groupBy("term", "stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def learn_lexicon(sample: DataFrame) -> Lexicon:
    sizes = dict(sample.groupBy("toxic").count().collect())
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    ratio = (F.col("bad") + 0.5) / (bad + 1) / ((F.col("good") + 0.5) / (good + 1))
    rows = term_counts(sample).where(F.col("bad") >= LEAST_DOCS).withColumn("ratio", ratio) \
        .where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("bad"), "term", "stem").limit(TERMS).collect()
    words = {r.term: r for r in rows if not r.stem}
    stems: dict[str, float] = {}
    for r in sorted((r for r in rows if r.stem), key=lambda r: len(r.term)):
        largest = max((w.bad for w in words.values() if w.term.startswith(r.term)), default=0)
        if not any(r.term.startswith(s) for s in stems) and largest < 0.7 * r.bad:
            stems[r.term] = float(np.log(r.ratio))
    return Lexicon({w: float(np.log(r.ratio)) for w, r in words.items() if not any(w.startswith(s) for s in stems)}, stems, any_start=True)


#: A worker's lexicons with the automata it has built, over the tasks that it runs.
_built: dict[tuple, Lexicon] = {}


def built(words: dict[str, float], stems: dict[str, float]) -> Lexicon:
    key = (tuple(words.items()), tuple(stems.items()))
    if key not in _built:
        _built.clear()
        _built[key] = Lexicon(words, stems, any_start=True)
    return _built[key]


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    weights: tuple[float, ...]
    bias: float

    def score(self, text: str, lexicon: Lexicon) -> float:
        z = self.bias + float(np.dot(self.weights, features(text, lexicon)))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """A model of ``labels.toxic`` from labelled documents outside the held-out fold, ``most`` of them at most.

    Labels that are null, or of unknown documents, are left out; without labels
    of both classes every score is the share of toxic ones (0 without any).
    """
    chosen = stored(labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic is not null").where(~held_out()).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most), "labelled")
    texts = doc_texts(docs).select(F.col("doc_id").alias("text_id"), "text")
    sample = stored(texts.join(F.broadcast(chosen), F.col("text_id") == F.col("doc_id"))  # most rows at most
                    .select("text", (F.col("toxic") == 1).alias("toxic")), "sample")
    lexicon = learn_lexicon(sample)

    words, stems = lexicon.words, lexicon.stems

    def run(batch: pa.RecordBatch):
        lexicon = built(words, stems)
        yield {"x": [features(t, lexicon) for t in batch.column("text").to_pylist()], "y": batch.column("toxic")}
    rows = map_batches(sample, run, "x array<double>, y boolean").toPandas()  # the bounded sample's few numbers
    y = rows["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(words, stems, (0.0,) * len(FEATURES), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    x = np.column_stack([np.ones(len(y)), np.array(rows["x"].tolist())])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 0.05)
    ridge[0] = 1e-6
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return Model(words, stems, tuple(w[1:].tolist()), float(w[0]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row of ``docs``.

    Null and empty texts have no hits and get the score of such documents; a
    row without doc_id is not held out; an empty table gives no rows; columns
    other than text have no part in the score.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch):
        lexicon = built(model.words, model.stems)
        s = np.array([model.score(t, lexicon) for t in batch.column("text").to_pylist()])
        yield {"doc_id": batch.column("doc_id"), "score": s, "predicted": (s >= 0.5).astype(np.int32)}
    return map_batches(doc_texts(docs), run, f"doc_id {ids}, score double, predicted int").select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    return score(docs, fit(docs, labels, most))


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """The documents that are not predicted toxic, all their columns, scored in place."""
    model = fit(docs, labels, most)
    names = docs.columns
    text = names.index("text")

    def run(batches):
        lexicon = built(model.words, model.stems)
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            keep = pa.array([model.score(t or "", lexicon) < 0.5 for t in batch.column(text).to_pylist()], pa.bool_())
            yield batch.filter(keep)
    return docs.mapInArrow(run, docs.schema)
