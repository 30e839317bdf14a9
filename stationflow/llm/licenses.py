"""License scan by diagonal voting, in DataFrame operations only.

All rolling word k-grams of all texts are hashed and joined to the positions of the templates' k-grams. A hit votes for
the diagonal (its word position less its template position); a verbatim passage puts all its votes on one diagonal, one with
words inserted or lost on neighbouring ones. Votes are aggregated by document, template and diagonal; diagonals at most
`slack` apart are merged; a merged span is verified by the share of the template's k-grams that it holds. Of spans that overlap (or are linked by
overlaps), those stay that hold half of the k-grams that set their template apart from other labels' templates; if none does, those of the best share.

The templates are few and given by the caller, so their table is broadcast; its size is checked. Hits alone are shuffled, with two
64-bit hashes of id and text as the document's key, so rows that are equal share their hits and each gets its own result row.

Defined results: null text counts as empty; a text with fewer words than a k-gram has no hit; repeated rows each give a
row; an empty table gives no rows; other columns are ignored. Texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .license_texts import TEMPLATES

#: Phrases that name a license, by the words before "license".
PHRASES = ((("mit",), "mit"), (("apache",), "apache"), (("general", "public"), "gpl"))
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MOST_TEMPLATE_WORDS = 1_000_000
#: Stands for the gram of the row that closes each document.
LAST = -1


def words(text: Column) -> Column:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters. lower() can't make or break a word, nor spell a phrase."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def grams(df: DataFrame, k: int, pos: str, *keep: str) -> DataFrame:
    """df (with w, its words) as a row for each word: `keep`, pos, gram (a hash of the k words from there on, null near the end), and a row more with LAST."""
    rows = df.select(*keep, "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias(pos, "__0"))  # no word is empty
    gram = F.xxhash64("__0", *(F.get("w", F.col(pos) + i) for i in range(1, k)))
    return rows.select(*keep, pos, F.when(F.col("__0") == "", F.lit(LAST)).when(F.col(pos) <= F.size("w") - k, gram).alias("gram"))


def template_grams(docs: DataFrame, templates, k: int) -> DataFrame:
    """tpl, label, grams (how many), own (does no other label's template hold it), owns (how many are so), pos, gram; and a row with LAST."""
    if sum(len(t.split()) for _, t in templates) > MOST_TEMPLATE_WORDS:
        raise ValueError("too many template words to broadcast")
    rows = docs.sparkSession.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "tpl int, label string, text string")
    rows = grams(rows.select("tpl", "label", words(F.col("text")).alias("w")), k, "pos", "tpl", "label").where(F.col("gram").isNotNull() & (F.col("gram") != LAST))
    of_gram, of_template = Window.partitionBy("gram"), Window.partitionBy("tpl")
    rows = rows.withColumn("own", F.min("label").over(of_gram) == F.max("label").over(of_gram))
    rows = rows.withColumns({"grams": F.count("*").over(of_template), "owns": F.count_if("own").over(of_template)})
    last = docs.sparkSession.createDataFrame([(-1, "", 0, LAST, False, 1, 0)], "tpl int, label string, pos int, gram long, own boolean, grams long, owns long")
    return rows.select(*last.columns).unionByName(last)


def hits(docs: DataFrame, templates, k: int, id: str, text: str) -> DataFrame:
    """Of every document: a row with tpl -1, its id, number of words and phrases; and a row for each of its grams that a template holds.

    The words are split once, and the rows are dealt out by document once, for all that follows.
    """
    w, named = F.col("w"), F.lower(F.col(text).cast("string")).contains("license")
    own = docs.select(F.col(id).alias("doc_id"), F.xxhash64(F.lit(1), F.col(id)).alias("k"), F.xxhash64(F.col(text).cast("string")).alias("t"), words(F.col(text)).alias("w"), named.alias("named"))
    none = F.array().cast("array<struct<at:int,label:string>>")
    own = own.select("doc_id", "k", "t", "w", F.when(F.col("named") & (F.size(w) > 0), base_places(w)).otherwise(none).alias("places"))
    found = grams(own, k, "at", "doc_id", "k", "t", "places").join(F.broadcast(template_grams(docs, templates, k)), "gram")
    document = F.col("tpl") == -1
    return found.select("k", "t", "tpl", "label", "grams", "own", "owns", "at", "pos", F.when(document, F.col("doc_id")).alias("doc_id"), F.when(document, F.col("places")).alias("places")).repartition("k", "t")


def spans(found: DataFrame, k: int = 3, slack: int = 2, least: float = 0.7) -> DataFrame:
    """k, t (the document's key), tpl, label, first, last (word positions), score: the verified spans of hits()."""
    doc = ["k", "t", "tpl", "label", "grams", "owns"]
    own = found.where("tpl >= 0").withColumn("diagonal", F.col("at") - F.col("pos"))
    votes = own.groupBy(*doc, "diagonal").agg(F.collect_set("pos").alias("held"), F.collect_set(F.when(F.col("own"), F.col("pos"))).alias("own"), F.min("at").alias("first"), F.max("at").alias("last"))
    by = Window.partitionBy(*doc).orderBy("diagonal")
    far = (F.col("diagonal") - F.lag("diagonal").over(by) > slack).cast("int")
    merged = votes.withColumn("run", F.sum(F.coalesce(far, F.lit(0))).over(by))
    many = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    merged = merged.groupBy(*doc, "run").agg(many("held").alias("held"), many("own").alias("own"), F.min("first").alias("first"), (F.max("last") + k - 1).alias("last"))
    merged = merged.withColumns({"score": F.col("held") / F.col("grams"), "strong": 2 * F.col("own") >= F.col("owns")}).where(F.col("score") >= least)
    here = Window.partitionBy("k", "t").orderBy("first", "tpl")
    new = F.coalesce((F.max("last").over(here.rowsBetween(Window.unboundedPreceding, -1)) < F.col("first")).cast("int"), F.lit(1))
    merged = merged.withColumn("new", new).withColumn("island", F.sum("new").over(here))
    island = Window.partitionBy("k", "t", "island")
    merged = merged.withColumns({"any": F.max("strong").over(island), "best": F.max("score").over(island)})
    merged = merged.where(F.col("strong") | (~F.col("any") & (F.col("score") == F.col("best"))))
    return merged.select("k", "t", "tpl", "label", "first", "last", "score")


def base_places(w: Column) -> Column:
    """(at, label) of each place of a phrase, in order."""
    before = lambda i, names: F.get(w, i - len(names)) == names[0] if len(names) == 1 else (F.get(w, i - 2) == names[0]) & (F.get(w, i - 1) == names[1])

    def place(i):
        out = F.lit(None).cast("struct<at:int,label:string>")
        for names, label in PHRASES:
            out = F.when(before(i, names), F.struct((i - len(names)).alias("at"), F.lit(label).alias("label"))).otherwise(out)
        return out

    here = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i) == "license")
    return F.filter(F.transform(here, place), lambda p: p.isNotNull())


def scan(docs: DataFrame, templates=TEMPLATES, k: int = 3, slack: int = 2, least: float = 0.7, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: phrases found word for word, and the labels that these and the verified spans give."""
    rows = cut(hits(docs, templates, k, id, text))  # few rows: hits, and one a document
    own = rows.where("tpl = -1").select("k", "t", "doc_id", F.col("at").cast("long").alias("n_words"), "places")
    found = spans(rows, k, slack, least).groupBy("k", "t").agg(F.collect_set("label").alias("found"), F.max("score").alias("score"))
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    both = F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>"))))
    return own.join(found.hint("merge"), ["k", "t"], "left").select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.at")).cast("long").alias("first_word"), F.array_max(F.col("places.at")).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
