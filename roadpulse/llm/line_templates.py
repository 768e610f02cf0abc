"""Line deduplication with a fixed-depth tree of log templates.

A line's tokens that hold a digit become wildcards: that is its form. The tree
leads by token count and the leading tokens to a leaf. A leaf whose forms agree
in most places is one template, the other places being variable; a mixed one is
split by the constant token that most documents share, its parts are judged
again, and so on for a fixed number of levels. Lines of a template, and lines of
one form, that occur in enough documents are dropped.

Built-in column functions only. Texts are masked once; each line is kept with
its place and the 128-bit digest of its form, and all counting and the last pass
read that. Forms themselves meet only where a leaf holds several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import doc_texts, stored

#: Leading tokens below the token count, and splits below them: the tree's depth.
DEPTH, SPLITS = 3, 3
#: Documents in which a template must occur to be dropped.
LEAST_DOCS = 3
#: Tenths: a place is constant if one token has this share of the group's votes,
#: a group is a template if this share of its places is constant, and a form is of it
#: if it agrees in this share of the constant places.
AGREED, CONSTANT, ALIKE = 5, 7, 8
#: A document's votes in a group, shared by its forms there.
VOTES = 720_720
_VARIABLE = r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+"
_ROW, _FORM = ["doc_id", "text_key"], ["a", "b"]


def masked(text: Column) -> Column:
    return F.regexp_replace(text, _VARIABLE, "<*>")


def _places(form: Column) -> Column:
    return F.length(form) - F.length(F.replace(form, F.lit(" "), F.lit(""))) + 1


def _digest(form: Column) -> list[Column]:
    return [F.xxhash64(form).alias("a"), F.xxhash64(F.lit(1), form).alias("b")]


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, k (place), leaf (hash), a, b (digest of the form), form of all lines but blank ones."""
    rows = docs.select(*_ROW, F.posexplode(F.split(masked(F.col("text")), "\n")).alias("k", "form")).where(F.trim("form") != "")
    form = F.col("form")
    return rows.select(*_ROW, "k", F.xxhash64(_places(form), F.substring_index(form, " ", DEPTH)).alias("leaf"), *_digest(form), "form")


def _narrower(*parts: Column) -> Column:
    """Key of the group that the parts lead to, 16 bytes."""
    return F.unhex(F.md5(F.concat_ws("\n", *parts)))


def judge(rows: DataFrame, texts: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """(a, b of the forms of templates; what is left, split into the groups of the next level).

    ``rows`` are distinct: doc_id, text_key, a, b, group; ``texts`` has the tokens of each form.
    """
    own = Window.partitionBy(*_ROW, "group")
    shares = rows.withColumn("forms", F.count("*").over(own)).withColumn("share", F.expr(f"{VOTES} div forms"))
    forms = stored(shares.groupBy("group", *_FORM).agg(F.sum("share").alias("weight")).join(texts, _FORM), "forms")
    votes = stored(forms.select("group", "weight", F.posexplode("parts").alias("at", "token"))
                   .groupBy("group", "at", "token").agg(F.sum("weight").alias("votes")), "votes")
    places = votes.groupBy("group", "at").agg(F.max(F.struct("votes", "token")).alias("top"), F.sum("votes").alias("total"))
    constant = F.when(10 * F.col("top.votes") >= AGREED * F.col("total"), F.struct("at", "top.token"))
    groups = stored(places.groupBy("group").agg(  # a place each: no more than a form has tokens
        F.collect_list(constant).alias("constants"), F.count("*").alias("places"), F.max("total").alias("total")), "groups")
    is_template = 10 * F.size("constants") >= CONSTANT * F.col("places")
    agree = F.size(F.filter("constants", lambda c: F.col("parts")[c["at"]] == c["token"]))
    judged = forms.join(groups.where(is_template), "group").select(
        "group", *_FORM, (10 * agree >= ALIKE * F.size("constants")).alias("alike"))
    # mixed groups: each form goes with the token that most votes are for, of those that tell forms apart
    mixed = stored(groups.where(~is_template).select("group", "total"), "mixed-groups")
    telling = votes.join(mixed, "group").where((F.col("votes") >= least_docs * VOTES) & (F.col("votes") < F.col("total"))).drop("total")
    tokens = forms.join(mixed.select("group"), "group", "left_semi").select("group", *_FORM, F.posexplode("parts").alias("at", "token"))
    chosen = tokens.join(telling, ["group", "at", "token"]).groupBy("group", *_FORM).agg(F.max(F.struct("votes", "at", "token")).alias("by"))
    moves = judged.where("alike").select("group", *_FORM, F.lit(None).cast("binary").alias("to")) \
        .union(judged.where("not alike").select("group", *_FORM, _narrower(F.hex("group")))) \
        .union(chosen.select("group", *_FORM, _narrower(F.hex("group"), F.col("by.at").cast("string"), F.col("by.token"))))
    moved = stored(rows.join(moves, ["group", *_FORM]), "moved")
    found = moved.where("to is null")
    enough = found.select("group", *_ROW).distinct().groupBy("group").agg(F.count("*").alias("docs")).where(F.col("docs") >= least_docs)
    templates = found.join(enough, "group", "left_semi").select(*_FORM)
    return templates, moved.where("to is not null").select(*_ROW, *_FORM, F.col("to").alias("group"))


def recurring(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """a, b: the digests of forms whose lines are to be dropped."""
    counts = stored(lines.select("leaf", *_FORM, *_ROW).distinct().groupBy("leaf", *_FORM).agg(F.count("*").alias("docs")), "form-counts")
    # stored, so that its size is known where it is joined: forms need not be shuffled for a few leaves
    leaves = stored(counts.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("forms")).where(
        (F.col("docs") >= least_docs) & (F.col("forms") > 1)).select("leaf"), "mixed-leaves")
    mixed = stored(lines.join(leaves, "leaf", "left_semi").select(*_ROW, *_FORM, "form"), "mixed-lines")
    texts = stored(mixed.groupBy(*_FORM).agg(F.first("form").alias("form")).select(*_FORM, F.split("form", " ").alias("parts")), "form-tokens")
    group = _narrower(_places(F.col("form")).cast("string"), F.substring_index("form", " ", DEPTH))
    rows = stored(mixed.select(*_ROW, *_FORM, group.alias("group")).distinct(), "mixed-rows")
    gone = counts.where(F.col("docs") >= least_docs).select(*_FORM)
    for _ in range(SPLITS + 1):
        if rows.isEmpty():
            break
        templates, rows = judge(rows, texts, least_docs)
        gone = gone.union(templates)
    return stored(gone.distinct(), "recurring")


def drop_recurring_lines(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (what is kept, lines joined by a line break), one row per row of ``docs``.

    Lines are what lies between line breaks; blank ones are kept and counted.
    Null counts as empty, which is one blank line. A document counts once for a
    template, however many of its lines are of it, and has ``VOTES`` votes on
    what is constant in a group, shared equally (rounded down) by its forms
    there. Rows of one doc_id, null included, and one text are one document. In
    a mixed group a form goes with the token for which the most votes are, of
    those with the votes of ``least_docs`` documents or more but not with all;
    of equal ones the last place. Forms of a template's group that are not of it
    are a group of their own on the next level. An empty table gives no rows;
    other columns are not looked at.
    """
    docs = doc_texts(docs).withColumn("text_key", F.xxhash64("text"))
    lines = stored(lines_of(docs), "lines")
    hits = lines.select(*_ROW, "k", *_FORM).join(recurring(lines, least_docs), _FORM, "left_semi")
    # places of dropped lines, no more than the document has lines
    per_doc = hits.groupBy(*_ROW).agg(F.sort_array(F.collect_set("k")).alias("gone")).withColumnRenamed("doc_id", "hit_id")
    both = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc["hit_id"]) & (docs["text_key"] == per_doc["text_key"]), "left")
    all_lines = F.split("text", "\n")
    cuts = F.concat(F.array(F.lit(-1)), "gone", F.array(F.size(all_lines)))  # kept lines lie between neighbours
    kept = F.flatten(F.transform(F.arrays_zip(
        F.slice(cuts, 1, F.size("gone") + 1).alias("a"), F.slice(cuts, 2, F.size("gone") + 1).alias("b")),
        lambda x: F.slice("lines", x["a"] + 2, x["b"] - x["a"] - 1)))
    some = both.withColumn("lines", all_lines).select(
        docs["doc_id"], F.size("lines").cast("bigint").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("int").alias("n_gone"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
    return some.select("doc_id", "n_lines", F.greatest("n_gone", F.lit(0)).alias("n_dropped"), "text")


def line_digests(docs: DataFrame) -> DataFrame:
    return drop_recurring_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
