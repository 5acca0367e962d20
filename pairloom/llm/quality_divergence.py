"""Quality verdicts by divergence from language references, in DataFrame expressions only.

A document's histogram of character classes and its histogram of common words are compared
with those of its language, which all documents of that language make up, by the
Jensen-Shannon distance (0 to 1).  Fewer than ``MIN_WORDS`` words say too little, and fail
the base rules anyway.  Before that the base rules look at the number of words and
at repeated windows of three words.

What a word distance can be depends on the share of a language's words that the common ones make
up, so its limit is ``MAX_WORD_SHARE`` of ``ref_reach``, the distance of a text that has none of them
(``MAX_SHORT_SHARE`` for a short text).
All documents together are no language whose common words a text must have: against them, and above
every language's limit, only ``MAX_WORD_DISTANCE`` counts, which takes an excess of some common word.

References come from one table of (language, word, count) over all documents; a language
with fewer than ``MIN_REFERENCE`` words, and a null language, is held against all documents.

Defined cases: a null text has no words; so have an empty one and one of white space, and they
fail; repeated rows and ties change nothing but the counts; equally frequent words are taken in
code point order; an empty table gives no rows; further columns of the input are not touched.
Windows are known by the upper bits of a 64-bit hash, so many that a text's positions leave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import SPACES, stored

COMMON_WORDS = 16
MIN_WORDS = 50  # where the base rule ends; a class histogram has some 250 characters then
MIN_REFERENCE = 10_000
MAX_CLASS_DISTANCE = 0.35
MAX_WORD_DISTANCE = 0.4
MAX_WORD_SHARE = 0.85  # of what a text without common words has
LONG_WORDS = 100
MAX_SHORT_SHARE = 0.98  # of the same, with fewer than LONG_WORDS words: chance alone leaves out more of the common ones
MAX_LANGUAGES = 10_000  # more references than this are joined without a broadcast

SYMBOLS = "#*$%&|<>"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
DIGITS = "0123456789"
MARKS = "!\"'()+,-./:;=?@[\\]^_`{}~"
CLASSES = ("lower", "upper", "digit", "symbol", "mark", "other")


def _without(text: str, chars: str) -> Column:
    return F.translate(F.col(text), chars, "")


def class_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds one count per character class (white space apart) and ``n_chars_all``.

    Each class is taken out of what the one before left, so only the first pass is over
    the whole text.
    """
    steps = (("lower", LOWER), ("space", SPACES), ("upper", UPPER), ("digit", DIGITS), ("symbol", SYMBOLS), ("mark", MARKS))
    rest = text
    for name, chars in steps:
        df = df.withColumn(f"_{name}", _without(rest, chars))
        df = df.withColumn(name, (F.length(rest) - F.length(f"_{name}")).cast("bigint"))
        rest = f"_{name}"
    return df.withColumn("other", F.length(rest).cast("bigint")).drop(*[f"_{name}" for name, _ in steps])


def split_words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{SPACES}]+"))


def repeated_words(words: str, bits: str) -> Column:
    """Words inside three-word windows that occur twice or more; ``bits`` is the length of the largest position."""
    # (hash, position) in one number: the array is then sorted without objects.
    windows = F.expr(
        f"case when size({words}) > 3 then sort_array(transform("
        f"arrays_zip(slice({words}, 1, size({words}) - 2), slice({words}, 2, size({words}) - 2), slice({words}, 3, size({words}) - 2)), "
        f"(x, i) -> shiftleft(xxhash64(x), {bits}) | i)) end"
    )
    let = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)  # noqa: E731  evaluated once a row
    same = lambda a, b: F.coalesce(F.call_function("shiftrightunsigned", a.bitwiseXOR(b), F.col(bits)) == 0, F.lit(False))
    position = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(bits)) - 1
    positions = let(windows, lambda s: F.transform(
        F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1))), lambda x: x.bitwiseAND(position)
    ))
    three = F.lit(3).cast("bigint")
    covered = let(F.sort_array(positions), lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(three, F.coalesce(F.get(p, i + 1) - x, three))),
        F.lit(0).cast("bigint"), lambda a, b: a + b,
    ))
    return F.coalesce(covered, F.lit(0).cast("bigint"))


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and ``_words``."""
    df = class_counts(df.withColumn("_text", F.coalesce(text, F.lit(""))), "_text")
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    let = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    df = df.withColumn("_words", split_words(F.col("_text"))).withColumn("_bits", F.length(F.bin(F.size("_words"))))
    return df.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0])),
        "n_symbols": F.col("symbol"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeated_words("_words", "_bits"),
    }).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def references(docs: DataFrame, text: str, lang: str, words: int = COMMON_WORDS) -> DataFrame:
    """ref_lang, ref_classes, ref_words, ref_counts, ref_total, ref_reach; the null language is all documents together."""
    counts = stored(
        docs.select(F.col(lang).alias("lang"), F.explode(split_words(F.coalesce(text, F.lit("")))).alias("word"))
        .groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts",
    )
    every = counts.groupBy("word").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(None).cast("string"))
    counts = counts.where("lang IS NOT NULL").unionByName(every)
    classes = class_counts(counts, "word")
    sums = classes.groupBy("lang").agg(
        F.sum("n").alias("total"), F.array(*[F.sum(F.col(c) * F.col("n")).cast("double") for c in CLASSES]).alias("ref_classes")
    )
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.withColumn("nth", F.row_number().over(by_count)).where(F.col("nth") <= words)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("nth", "word", "n"))).alias("top"))
    made = sums.join(top, sums["lang"].eqNullSafe(top["lang"])).drop(top["lang"])
    return stored(
        made.where(F.col("lang").isNull() | (F.col("total") >= MIN_REFERENCE)).select(
            F.col("lang").alias("ref_lang"), "ref_classes", F.col("top.word").alias("ref_words"),
            F.transform("top.n", lambda n: n.cast("double")).alias("ref_counts"),
            F.col("total").cast("double").alias("ref_total"),
        ).withColumn("ref_reach", js_distance(
            F.concat(F.transform("ref_counts", lambda n: F.lit(0.0)), F.array(F.lit(1.0))), _with_rest("ref_counts", "ref_total")
        )), "references",
    )


def _with_rest(counts: str, total: str) -> Column:
    return F.concat(counts, F.array(F.col(total) - F.aggregate(counts, F.lit(0.0), lambda x, y: x + y)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of counts; 0 where one of them is empty."""
    let = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    part = lambda x, m: F.when(x.isNull(), x).when(x > 0, x * F.log2(x / m)).otherwise(0.0)  # noqa: E731  null: no histogram
    pairs = let(F.struct(total(p).alias("p"), total(q).alias("q")), lambda t: F.transform(
        F.arrays_zip(p.alias("p"), q.alias("q")), lambda x: F.struct(F.try_divide(x["p"], t["p"]).alias("p"), F.try_divide(x["q"], t["q"]).alias("q"))
    ))
    divergence = F.aggregate(
        F.transform(pairs, lambda x: part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2)),
        F.lit(0.0), lambda a, b: a + b,
    ) / 2
    return F.coalesce(F.sqrt(F.greatest(divergence, F.lit(0.0))), F.lit(0.0))


def judged(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the base counts, class_distance, word_distance and ``kept``."""
    refs = references(docs, text, lang)
    known = refs.count()
    overall = refs.where("ref_lang IS NULL").drop("ref_lang").select(*[F.col(c).alias(f"all_{c}") for c in ("ref_classes", "ref_words", "ref_counts", "ref_total")])
    # Without a reference of its language a text has no ``ref_reach``.
    own = refs.where("ref_lang IS NOT NULL")
    small = (lambda x: F.broadcast(x)) if known <= MAX_LANGUAGES else (lambda x: x)
    columns = docs.columns
    joined = docs.join(small(own), docs[lang] == own["ref_lang"], "left").join(F.broadcast(overall), F.lit(True), "left")
    for c in ("ref_classes", "ref_words", "ref_counts", "ref_total"):
        joined = joined.withColumn(c, F.coalesce(c, f"all_{c}")).drop(f"all_{c}")
    counted = base_counts(joined, text)
    # Words are padded and set apart by two blanks, so each occurrence is cut out on its own.
    padded = counted.withColumn("_padded", F.concat(F.lit(" "), F.array_join("_words", "  "), F.lit(" "))).drop("_words", "_text", "_bits")
    hits = F.transform("ref_words", lambda w: (
        (F.octet_length("_padded") - F.octet_length(F.replace(F.col("_padded"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
        / (F.octet_length(w) + 2)
    ))
    counted = padded.withColumn("_hits", hits).withColumns({
        "class_distance": js_distance(F.array(*[F.col(c).cast("double") for c in CLASSES]), F.col("ref_classes")),
        "word_distance": js_distance(
            _with_rest("_hits", "n_words"), _with_rest("ref_counts", "ref_total"),
        ),
    })
    share = F.when(F.col("n_words") < LONG_WORDS, MAX_SHORT_SHARE).otherwise(MAX_WORD_SHARE)
    reach = F.coalesce(F.col("word_distance") > share * F.col("ref_reach"), F.lit(False))
    strange = (F.col("n_words") >= MIN_WORDS) & (
        (F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE) | reach
    )
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance"]
    return counted.withColumn("kept", ~F.col("base_failed") & ~strange).select(*columns, *added, "kept")
