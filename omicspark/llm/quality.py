"""Quality rules: a table of thresholds compiled into one projection of native functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, documents

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the be to of and that have with in is for on it as was are by at from this or an "
    "der die das und in zu den von mit ist im für auf sich nicht ein eine dem des es "
    "le la les de des et un une que en du dans est pour qui pas sur au il "
    "el los las y no se del por con una su para es al lo como más o"
).split()

#: (measure, least, most): a document is kept if each measure lies within its bounds.
THRESHOLDS = (
    ("n_words", 50, 1_000_000),
    ("mean_word_chars", 2.0, 12.0),
    ("symbol_ratio", None, 0.10),
    ("stop_word_ratio", 0.03, None),
    ("dup_line_ratio", None, 0.50),
    ("upper_ratio", None, 0.40),
    ("bullet_line_ratio", None, 0.90),
    ("ellipsis_line_ratio", None, 0.30),
)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once a row however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more.

    Windows are sorted as longs of 44 hash bits and their place; neighbours with equal hash bits are candidates, which are
    then compared as strings, so that a hash collision counts for nothing. The gaps of the places that remain give the words.
    """
    bits, places = 20, (1 << 20) - 1

    def window(w: Column, i: Column) -> Column:
        return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def covered(at: Column) -> Column:
        gap = F.transform(at, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(at, i - 1))))
        return F.aggregate(gap, F.lit(0).cast("bigint"), lambda total, g: total + g)

    def equal(windows: Column) -> Column:
        near = lambda i: F.coalesce(F.get(windows, i)["s"], F.lit(""))
        same = F.filter(windows, lambda w, i: (near(i - 1) == w["s"]) | (near(i + 1) == w["s"]))
        return let(F.array_sort(F.transform(same, lambda w: w["p"])), covered)

    def exactly(w: Column, at: Column) -> Column:
        return let(F.array_sort(F.transform(at, lambda i: F.struct(window(w, i).alias("s"), i.alias("p")))), equal)

    def candidates(w: Column, keys: Column) -> Column:
        first = F.filter(F.transform(keys, lambda k, i: F.when(F.shiftrightunsigned(k.bitwiseXOR(F.get(keys, i + 1)), bits) == 0, i)), lambda i: i.isNotNull())
        found = lambda xs: F.when(F.size(xs) == 0, F.lit(0).cast("bigint")).otherwise(
            exactly(w, F.transform(F.array_distinct(F.concat(xs, F.transform(xs, lambda i: i + 1))), lambda i: F.get(keys, i).bitwiseAND(places).cast("int")))
        )
        return let(first, found)

    def hashed(w: Column) -> Column:
        key = lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(~places).bitwiseOR(i.cast("bigint"))
        return F.sort_array(F.transform(F.slice(w, 1, F.size(w) - 2), key))

    few, many = F.size(words) < 4, F.size(words) > places
    return (
        F.when(few, F.lit(0).cast("bigint"))
        .when(many, exactly(words, F.sequence(F.lit(0), F.size(words) - 3)))
        .otherwise(let(hashed(words), lambda keys: candidates(words, keys)))
    )


def measures(text: Column) -> Column:
    """A struct of counts and ratios of one text; null reads as empty, and ratios of nothing are 0."""
    text = F.coalesce(text, F.lit(""))
    bare = lambda s, drop: F.length(F.translate(s, drop, ""))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    matching = lambda xs, p: F.size(F.filter(xs, p))

    def of(x: Column) -> Column:
        lines, n = x["lines"], F.size(x["words"])
        own = lambda p: matching(lines, lambda line: line.rlike(p))
        return F.struct(
            n.cast("bigint").alias("n_words"),
            x["chars"].cast("bigint").alias("word_chars"),
            x["symbols"].cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            repeated_words(x["words"]).cast("bigint").alias("n_repeat_words"),
            ratio(x["chars"], n).alias("mean_word_chars"),
            ratio(x["symbols"], n).alias("symbol_ratio"),
            ratio(matching(x["words"], lambda w: w.isin(*STOP_WORDS)), n).alias("stop_word_ratio"),
            ratio(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)).alias("dup_line_ratio"),
            ratio(x["upper"], x["chars"]).alias("upper_ratio"),
            ratio(own(r"^\s*[-*•]"), F.size(lines)).alias("bullet_line_ratio"),
            ratio(own(r"(\.\.\.|…)\s*$"), F.size(lines)).alias("ellipsis_line_ratio"),
        )

    parts = F.struct(
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        bare(text, BLANK).alias("chars"),
        (F.length(text) - bare(text, SYMBOLS)).alias("symbols"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("upper"),
    )
    return let(parts, of)


def compile_rules(thresholds: Iterable[tuple[str, float | None, float | None]], of: Column) -> Column:
    """One boolean column: every measure of the table within its bounds (None: open)."""
    verdict = F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            verdict = verdict & (of[name] >= least)
        if most is not None:
            verdict = verdict & (of[name] <= most)
    return verdict


def score_quality(docs: DataFrame, text_col: str = "text", thresholds: Iterable[tuple] = THRESHOLDS) -> DataFrame:
    """docs with the struct column `quality` (measures, base_failed, kept); an existing column of that name is replaced.

    Null and empty texts have no words, fail the base rule and are not kept. Rows are judged one by one: repeated rows get
    the same verdict, an empty table stays empty, and nothing is shuffled.
    """
    scored = docs.withColumn("quality", measures(F.col(text_col)))
    m = F.col("quality")
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])
    return scored.withColumn("quality", m.withField("base_failed", failed).withField("kept", ~failed & compile_rules(thresholds, m)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return score_quality(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", *(q[n].alias(n) for n in names))
