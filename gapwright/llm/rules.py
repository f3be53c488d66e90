"""Quality rules by distribution divergence, with DataFrame functions only.

Base rules: too few words, or too many words inside five-word windows that the text repeats. The method: each
document's histogram of character classes, and of its language's common words and the rest, is compared with
the language's reference by Jensen-Shannon distance (square root of the base-2 divergence). The references are
grouped sums over all documents: the `COMMON` most frequent words (ties by name) and the class totals, a row for
every language, joined by language. Documents too short for a histogram (`least_chars`, `least_words`) are not judged by it.

Nulls: a null text is empty. Documents of null or empty language, and of a language without a word, are held
against the pooled reference. Windows are told apart by 64-bit hashes within their document. Repeated rows each get
the same answer; an empty table gives no rows. Other columns pass through in struct `row`, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BLANK_RE, BLANKS, small, staged

COMMON, WINDOW = 10, 5
#: Largest distances of a document that is kept, and the lengths below which there is no verdict (fixed on the labelled rows at sf0.1).
MOST_CHARS, MOST_WORDS, LEAST_CHARS, LEAST_WORDS = 0.2, 0.45, 60, 40
#: Character classes, taken off the text one after another; what is left is the last class.
CLASSES = {"lower": "[a-z]+", "blank": BLANK_RE, "upper": "[A-Z]+", "digit": "[0-9]+", "symbol": "[#*$%&|<>]+", "mark": "[!-/:-@\\[-`{-~]+"}


def words_in(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RE))


def with_classes(df: DataFrame) -> DataFrame:
    """Adds `classes`: the text's code points by class, in the order of CLASSES and then the rest."""
    sizes, text = [F.length("text")], "text"
    for k, pattern in enumerate(CLASSES.values()):
        df = df.withColumn(f"_t{k}", F.regexp_replace(text, pattern, ""))
        text = f"_t{k}"
        sizes.append(F.length(text))
    left = [F.length("text") if not k else F.col(f"_n{k - 1}") for k in range(len(sizes))]
    for k in range(len(CLASSES)):
        df = df.withColumn(f"_n{k}", F.length(f"_t{k}"))
    counts = [left[k] - F.col(f"_n{k}") for k in range(len(CLASSES))] + [F.col(f"_n{len(CLASSES) - 1}")]
    return df.withColumn("classes", F.array(*counts)).drop(*(f"_{x}{k}" for x in "tn" for k in range(len(CLASSES))))


def references(docs: DataFrame) -> DataFrame:
    """docs (text, lang) -> ref_lang ('' is pooled), common words, their share and that of the rest, class shares (a staged table)."""
    named = docs.select("text", F.when(F.col("lang") != "", F.col("lang")).alias("lang"))
    words = named.select("lang", F.explode(words_in(F.lower("text"))).alias("word"))
    counts = staged(words.groupBy("lang", "word").agg(F.count("*").alias("n")))
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang"), "word", "n")
    each = counts.where("lang is not null").unionByName(pooled)
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    best = each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= COMMON)
    best = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("best"))
    total = each.groupBy("lang").agg(F.sum("n").alias("total"))
    n = len(CLASSES) + 1
    sums = staged(with_classes(named).groupBy("lang").agg(*(F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(n))))
    every = sums.agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(n))).select(F.lit("").alias("lang"), *(f"c{k}" for k in range(n)))
    known = sums.where("lang is not null").unionByName(every).join(total, "lang", "left").join(best, "lang", "left")
    own = F.greatest(F.lit(1), sum(F.col(f"c{k}") for k in range(n)))
    found = staged(known.select(F.col("lang").alias("ref_lang"), "total", "best", F.array(*(F.col(f"c{k}") / own for k in range(n))).alias("char_ref")))
    grand = found.where("ref_lang = ''").first()
    # a language without a word takes the pooled row
    row = docs.sparkSession.createDataFrame([grand], found.schema).withColumnRenamed("ref_lang", "pooled")
    bare = found.where("total is null").select("ref_lang", F.lit("").alias("pooled"))
    found = found.where("total is not null").unionByName(bare.join(F.broadcast(row), "pooled").drop("pooled"))
    best = F.coalesce("best", F.array().cast("array<struct<place:int,word:string,n:bigint>>"))
    shares = F.transform("best", lambda x: x["n"] / F.col("total"))
    found = found.withColumn("best", best)
    rest = 1 - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return staged(found.select("ref_lang", F.transform("best", lambda x: x["word"]).alias("common"), F.concat(shares, F.array(rest)).alias("word_ref"), "char_ref"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts and one of shares."""
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    part = lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
    terms = F.zip_with(counts, reference, lambda c, q: part(c / total, q) + part(q, c / total))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))) / 2))


def measured(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each row of docs as struct `row`, with the base measures, both distances, base_failed and kept."""
    source = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    refs = references(source.select("text", "lang"))
    df = source.withColumn("ref_lang", F.coalesce("lang", F.lit(""))).join(small(refs), "ref_lang")
    df = with_classes(df).withColumn("words", words_in(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    df = df.withColumn("lines", lines).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    # repeated windows: hashes that occur twice, then the words that their positions cover
    last = F.size("words") - WINDOW
    window = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW))))
    df = df.withColumn("h", F.when(last >= 0, window))
    df = df.withColumn("many", F.size(F.array_distinct("h")) < F.size("h"))
    df = df.withColumn("s", F.when(F.col("many"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    twice = F.transform("s", lambda x, j: F.when((F.get("s", j - 1)["h"] == x["h"]) | (F.get("s", j + 1)["h"] == x["h"]), x["i"]))
    df = df.withColumn("at", F.sort_array(F.filter(twice, lambda x: x.isNotNull())))
    covered = F.transform("at", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("at", j + 1) - x, F.lit(WINDOW))))
    df = df.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
    # each word stands between two blanks of its own, so taking a word out with them never joins its neighbours
    df = df.withColumn("spaced", F.concat(F.lit(" "), F.lower(F.array_join("words", "  ")), F.lit(" ")))
    one = lambda w: ((F.octet_length("spaced") - F.octet_length(F.replace("spaced", F.concat(F.lit(" "), w, F.lit(" "))))) / (F.octet_length(w) + 2)).cast("long")
    df = df.withColumn("hits", F.transform("common", one))
    rest = F.col("n_words") - F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("char_distance", distance(F.transform("classes", lambda x: x.cast("long")), F.col("char_ref")))
    df = df.withColumn("word_distance", distance(F.concat("hits", F.array(rest)), F.col("word_ref")))
    blank = F.col("classes")[list(CLASSES).index("blank")]
    df = df.withColumns({"n_chars_": F.length("text").cast("long"), "word_chars": (F.length("text") - blank).cast("long"), "n_symbols": F.col("classes")[list(CLASSES).index("symbol")].cast("long")})
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "n_chars_", "char_distance", "word_distance")


def judged(docs: DataFrame, most_chars: float = MOST_CHARS, most_words: float = MOST_WORDS, least_chars: int = LEAST_CHARS, least_words: int = LEAST_WORDS, **columns) -> DataFrame:
    """measured() with the verdict: kept unless the base rules fail or a distance is too large for its length guard."""
    far = (F.col("n_chars_") >= least_chars) & (F.col("char_distance") > most_chars) | (F.col("n_words") >= least_words) & (F.col("word_distance") > most_words)
    return measured(docs, **columns).withColumn("kept", ~F.col("base_failed") & ~far).drop("n_chars_")


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, columns unchanged, that pass."""
    # the id, never negative, keeps the filter above the projections: pushed below them, it would repeat all they compute
    verdict = judged(docs, **options).select("row", (F.col("kept") & (F.monotonically_increasing_id() >= 0)).alias("kept"))
    return verdict.where("kept").select("row.*")


def op1_distribution_divergence(spark, sf_dir: str) -> DataFrame:
    """Query: the measures and the verdict of every document."""
    out = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))
