"""Quality rules by distribution divergence, in DataFrame functions alone.

A document's histogram of character classes and its histogram of common words are compared by Jensen-Shannon distance with
the references of its language, which are the mean histograms of the language's sound documents. Short texts say little
about a distribution, so a histogram is only judged from a least number of words on.

How far common words may be from the reference depends on how many of them a language has and on the length of a text. So the
limit is taken from the distances themselves, for each language and class of length: the median and three times what lies between
it and the lowest tenth. Both hold still while a good part of the documents is junk, as junk is far off on the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import WORD
from jobloom.once import computed_once
from jobloom.scratch import materialize

#: Least words of a text: for any verdict, for either histogram.
LEAST_WORDS, LEAST_FOR_CLASSES, LEAST_FOR_COMMON = 50, 50, 50
#: Greatest Jensen-Shannon distance (base 2, 0 to 1) of the classes of characters from their reference.
FAR_CLASSES = 0.30
#: Words from which on a text is in the next class of length; distances are counted in steps of a thousandth.
LENGTHS, STEPS = (75, 100, 150, 250, 500, 1000), 1000
#: The limit of the common words: so many times what lies between the lowest tenth and the median, and steps above the median.
SPREADS, MARGIN = 3, 10
#: Languages whose references are sent to all tasks; a reference is some ninety numbers.
MOST_SENT = 10_000
#: A text fails if windows found again cover more than this share of its words.
REPEATED_PERCENT = 50
# Character classes, each the complement to delete; what is in none of them is the last class.
BLANK, SYMBOL = r"[^\x20\x09-\x0D]+", r"[^#*$%&|<>]+"
CLASSES = ("[^a-z]+", "[^A-Z]+", r"[a-zA-Z\P{L}]+", "[^0-9]+", BLANK, "[^.,;:!?'\"()-]+", SYMBOL)
# Frequent words of English, German, French and Spanish.
COMMON = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "his", "are",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch",
    "de", "la", "le", "et", "les", "du", "une", "un", "est", "que", "dans", "qui", "par", "pour", "au", "sur", "pas", "plus", "avec", "ce",
    "el", "y", "los", "se", "del", "las", "por", "con", "para", "su", "al", "lo", "como", "más", "pero", "sus", "no", "una", "o", "este",
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def covered_by_repeats(windows: Column, n: int) -> Column:
    """How many words lie in windows of ``n`` words that stand in the text more than once; ``windows`` are their hashes.

    Windows are sorted by hash, so equal ones are neighbours; the places of these, sorted, give the words covered.
    """
    def places(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            same = lambda x, k: (
                F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
            )
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        return F.transform(F.array(pairs), again)[0]

    def length(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(n)), F.lit(n)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, F.transform(F.array(places(windows)), length)[0]).otherwise(F.lit(0).cast("long"))


def _part(p: Column, q: Column) -> Column:
    middle = (p + q) / 2
    one = lambda v: F.when(v > 0, v * F.log2(v / middle)).otherwise(0.0)
    return (one(p) + one(q)) / 2


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares; null if either is."""
    return F.sqrt(F.greatest(_total(F.zip_with(p, q, _part)), F.lit(0.0)))


def sparse_distance(p: Column, q: Column) -> Column:
    """The same of a histogram as (word, share) pairs and a reference as a map of shares; a bin of one side alone adds half."""
    both = F.transform(p, lambda e: F.struct(e["share"].alias("p"), F.coalesce(F.try_element_at(q, e["word"]), F.lit(0.0)).alias("q")))

    def whole(pairs: Column) -> Column:
        absent = 1 - _total(F.transform(pairs, lambda x: x["q"]))
        return F.sqrt(F.greatest(_total(F.transform(pairs, lambda x: _part(x["p"], x["q"]))) + absent / 2, F.lit(0.0)))

    return F.when(q.isNotNull(), F.transform(F.array(both), whole)[0])


def word_shares(common: Column, whole: Column) -> Column:
    """(word, share) pairs of the words in ``common``, and of all others under the empty word; null without a word."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda w, i: F.when((i == 0) | (w != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        return F.transform(F.array(starts), lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("word"), ((F.coalesce(F.get(at, k + 1), F.size(s)) - i) / whole).alias("share"),
        )))[0]

    rest = F.struct(F.lit("").alias("word"), ((whole - F.size(common)) / whole).alias("share"))
    found = F.transform(F.array(F.sort_array(common)), runs)[0]
    return F.when(whole > 0, F.concat(found, F.array(rest)))


def shares(counts: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.transform(counts, lambda c: c / whole))


def measured(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Counts and histograms of every text; the text itself stays behind."""
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = computed_once(rows, {
        "words": words_of(F.col("text")),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)),
        "plain": F.split(F.lower(F.regexp_replace("text", r"\P{L}+", " ")), " "),
        "n_chars": F.length("text").cast("long"),
        "classes": F.array(*[F.length(F.regexp_replace("text", c, "")).cast("long") for c in CLASSES]),
    }, keep=["key", "lang"])
    n = F.size("words")
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    rows = computed_once(rows, {
        "n_words": n.cast("long"),
        "word_chars": F.col("n_chars") - F.get("classes", CLASSES.index(BLANK)),
        "n_symbols": F.get("classes", CLASSES.index(SYMBOL)),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "windows": windows,
        "common": F.filter("plain", lambda w: w.isin(*COMMON)),
        "n_plain": F.size(F.array_remove("plain", "")),
    }, keep=["key", "lang", "n_chars", "classes"])
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda x, y: x + y)
    classes = F.concat("classes", F.array(F.greatest(F.col("n_chars") - total, F.lit(0))))
    return computed_once(rows, {
        "n_repeat_words": covered_by_repeats(F.col("windows"), 3),
        "classes": shares(classes, F.col("n_chars")),
        "common": word_shares(F.col("common"), F.col("n_plain")),
    }, keep=["key", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines"])


def common_limits(rows: DataFrame) -> DataFrame:
    """``of``, ``length_of`` and ``limit``, in steps, from the distances (``lang``, ``length``, ``steps``) of sound documents.

    Distances are counted by their step first, so a group is as many rows as there are steps.
    """
    counts = rows.where("steps IS NOT NULL").groupBy("lang", "length", "steps").agg(F.count("*").alias("n"))
    below = Window.partitionBy("lang", "length").orderBy("steps")
    counts = counts.withColumn("up_to", F.sum("n").over(below)).withColumn("all", F.sum("n").over(Window.partitionBy("lang", "length")))
    step_at = lambda part: F.min(F.when(F.col("up_to") * part >= F.col("all"), F.col("steps")))
    limits = counts.groupBy("lang", "length").agg(step_at(2).alias("median"), step_at(10).alias("low"))
    limit = F.col("median") + SPREADS * (F.col("median") - F.col("low")) + MARGIN
    return limits.select(F.col("lang").alias("of"), F.col("length").alias("length_of"), limit.alias("limit"))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Key, counts, ``base_failed``, the two distances and ``kept`` for every row.

    A null or empty text has no words and fails the base rule. A distance is null, and speaks against no one, where the text
    is shorter than the guard, where it has no characters or no letters, and where the language has no sound document. A
    null language is a language of its own. Repeated rows are judged each; other columns are not read, whatever their names; an
    empty table gives an empty result.
    """
    rows = measured(docs, key, text, lang)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    rows = materialize(rows.withColumn("base_failed", failed), "measured")
    sound = rows.where(~F.col("base_failed"))
    # As many values for a language as there are classes of characters and common words.
    classes_of = (
        sound.select("lang", F.posexplode("classes").alias("k", "share")).groupBy("lang", "k").agg(F.avg("share").alias("mean"))
        .groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "mean"))), lambda x: x["mean"]).alias("classes_of"))
    )
    sizes = sound.where("common IS NOT NULL").groupBy("lang").agg(F.count("*").alias("docs"))
    sums = sound.select("lang", F.inline("common")).groupBy("lang", "word").agg(F.sum("share").alias("sum"))
    common_of = (
        sums.withColumnRenamed("lang", "of").join(sizes, F.col("of").eqNullSafe(F.col("lang")))
        .groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("word", F.col("sum") / F.col("docs")))).alias("common_of"))
    )
    for mean in (classes_of, common_of):
        mean = materialize(mean.withColumnRenamed("lang", "of"), "references")
        if mean.count() <= MOST_SENT:  # else an ordinary join, which a frequent language makes uneven
            mean = F.broadcast(mean)
        rows = rows.join(mean, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")
    rows = computed_once(rows, {
        "class_distance": F.when(F.col("n_words") >= LEAST_FOR_CLASSES, distance(F.col("classes"), F.col("classes_of"))),
        "common_distance": F.when(F.col("n_words") >= LEAST_FOR_COMMON, sparse_distance(F.col("common"), F.col("common_of"))),
    })
    length = sum((F.when(F.col("n_words") >= n, 1).otherwise(0) for n in LENGTHS), F.lit(0))
    rows = rows.withColumns({"length": length, "steps": F.floor(F.col("common_distance") * STEPS)})
    limits = materialize(common_limits(rows.where(~F.col("base_failed"))), "limits")
    if limits.count() <= MOST_SENT:
        limits = F.broadcast(limits)
    rows = rows.join(limits, F.col("lang").eqNullSafe(F.col("of")) & (F.col("length") == F.col("length_of")), "left")
    near = F.coalesce(F.col("class_distance") <= FAR_CLASSES, F.lit(True))
    near &= F.coalesce(F.col("steps") <= F.col("limit"), F.lit(True))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        F.col("key").alias(key), *counts, "base_failed", (~F.col("base_failed") & near).alias("kept"),
        "class_distance", "common_distance",
    )


def judge_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: counts and verdict of every document."""
    return judge(documents.select("doc_id", "text", "lang")).drop("class_distance", "common_distance")
