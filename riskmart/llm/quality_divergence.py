"""Quality rules by distribution divergence.

The histogram of a document over character classes, and the one over the common words of
its language, are compared to the references of that language with the Jensen-Shannon
distance (square root of the divergence, base 2: 0 to 1). References are gathered from
all documents with enough text, so one language reference never hangs on few texts.

Common words count in lower, title and upper case. Every language with ``LANGUAGE_WORDS``
words gets a reference, whatever its share; NULL is a language like others. A document of
a language without one is judged by the base rule only.

Guards: a histogram is judged only when it holds enough; the limit grows by a term for
the sampling noise of short histograms, ``noise / sqrt(n)``.

Defined cases: NULL text counts as empty and fails the base rule; without any reference
(empty table, short texts only) nothing fails by distance; repeated rows are judged
alike; extra columns pass through, those with the names of MEASURES only in ``passing``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import BLANK_RUN, stored, words

MIN_WORDS = 50
#: Characters of a text that counts for the references.
MIN_CHARS = 250
SYMBOLS = "#*$%&|<>"
COMMON_WORDS = 32
#: Bits of a number that hold the place of a window in its text.
PLACE_BITS = 24
#: Words of long enough texts that make the reference of a language.
LANGUAGE_WORDS = 5_000

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance",
    "word_distance", "kept",
)

#: Character classes; what no class has counts as ``other``.
CLASSES = ("lower", "upper", "digit", "stop", "symbol", "blank", "other")
CHAR_LIMIT, CHAR_NOISE = 0.2, 0.8
WORD_LIMIT, WORD_NOISE = 0.16, 2.2


#: What is left of a text after each step; each step works on what the one before left.
#: Lower-case letters go first, as they are most of a text.
STEPS = (
    ("lower", r"\p{Ll}++"),
    ("blank", r"[\x20\x09-\x0D]++"),
    ("upper", r"\p{Lu}++"),
    ("digit", r"[0-9]++"),
    ("stop", r"[.,;:!?'\"()\-]++"),
    ("symbol", r"[#*$%&|<>@^~_=+/\\{}\[\]`]++"),
)


def classified(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``chars``, the counts of CLASSES in the column ``text``, and ``n_symbols``."""
    before, out, names = text, docs, []
    for name, pattern in STEPS:
        out = out.withColumn(f"_no_{name}", F.regexp_replace(before, F.lit(pattern), F.lit("")))
        names.append((name, before, f"_no_{name}"))
        before = f"_no_{name}"
    counts = {name: F.length(a) - F.length(b) for name, a, b in names} | {"other": F.length(before)}
    marked = F.col("_no_blank")
    for symbol in SYMBOLS:
        marked = F.replace(marked, F.lit(symbol), F.lit(""))
    return out.withColumn("chars", F.array(*[counts[c].cast("long") for c in CLASSES])).withColumn(
        "n_symbols", (F.length("_no_blank") - F.length(marked)).cast("long")
    ).drop(*[b for _, _, b in names])


def _neighbour_is_equal(values: str, part) -> Column:
    """Elements of a sorted array whose neighbour agrees in ``part``."""
    return F.filter(
        values,
        lambda x, j: (part(x) == part(F.get(values, j + 1)))
        | ((j > 0) & (part(x) == part(F.get(values, F.greatest(j - 1, F.lit(0)))))),
    )


def measured(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in ``row``, words, character classes and the base measures.

    Three-word windows that occur twice are found in sorted arrays: first by 40 bits of
    their hash, packed with their place into one number, then, for the few that are left,
    by the whole hash.
    """
    split = classified(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
            F.coalesce(F.col("text"), F.lit("")).alias("body"),
        ),
        "body",
    ).select(
        "*",
        words(F.col("body")).alias("words"),
        F.filter(
            F.split("body", "\n"), lambda line: F.length(F.regexp_replace(line, BLANK_RUN, "")) > 0
        ).alias("lines"),
    )
    hashed = split.select(
        "row",
        "body",
        "chars",
        "n_symbols",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice(
            F.transform(
                "words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))
            ),
            F.lit(1),
            F.greatest(F.size("words") - 2, F.lit(0)),
        ).alias("hashes"),
    )
    packed = hashed.withColumn(
        "sorted",
        # Without a repeated window there is nothing to sort.
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(
            F.transform(
                "hashes",
                lambda h, i: F.shiftleft(F.shiftrightunsigned(h, PLACE_BITS), PLACE_BITS).bitwiseOR(i.cast("long")),
            )
        )).otherwise(F.array().cast("array<bigint>")),
    )
    alike = packed.withColumn(
        "alike",
        F.transform(
            _neighbour_is_equal("sorted", lambda x: F.shiftrightunsigned(x, PLACE_BITS)),
            lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"),
        ),
    )
    exact = alike.withColumn(
        "exact",
        F.sort_array(
            F.transform("alike", lambda i: F.struct(F.get("hashes", i).alias("h"), i.alias("i")))
        ),
    )
    repeated = exact.withColumn(
        "starts",
        F.sort_array(F.transform(_neighbour_is_equal("exact", lambda x: x["h"]), lambda x: x["i"])),
    )
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda s, j: F.coalesce(F.least(F.lit(3), F.get("starts", j + 1) - s), F.lit(3)),
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return repeated.withColumn("n_repeat_words", covered).drop("hashes", "sorted", "alike", "exact", "starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """Per language (``ref_lang``) the shares of character classes and of its common words.

    Two aggregates with map-side sums over all documents.
    """
    long_ = docs.select(
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).where(F.length("text") >= MIN_CHARS)
    sums = classified(long_, "text").groupBy("lang").agg(
        *[F.sum(F.get("chars", F.lit(k))).alias(c) for k, c in enumerate(CLASSES)]
    )
    # Case is folded after the first sums, on the vocabulary instead of on all texts.
    counted = stored(
        long_.select("lang", F.explode(words(F.col("text"))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("times"))
        .groupBy("lang", F.lower("word").alias("word"))
        .agg(F.sum("times").alias("times")),
        "language-words",
    )
    sizes = counted.groupBy("lang").agg(F.sum("times").alias("n")).where(F.col("n") >= LANGUAGE_WORDS)
    # Rank limits are applied before and after the shuffle, so a task gets few rows.
    top = (
        counted.withColumn("place", F.expr("row_number() OVER (PARTITION BY lang ORDER BY times DESC, word)"))
        .where(F.col("place") <= common)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "word", "times"))).alias("top"))
    )
    chars = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    return stored(
        sums.join(sizes, "lang").join(top, "lang").select(
            F.col("lang").alias("ref_lang"),
            F.struct(
                F.col("top.word").alias("words"),
                F.transform("top.times", lambda t: t / F.col("n")).alias("shares"),
                F.array(*[F.col(c) / chars for c in CLASSES]).alias("chars"),
            ).alias("ref"),
        ),
        "language-references",
    )


def _pair(p: Column, q: Column) -> Column:
    """One bin's part of twice the divergence, in bits."""
    left = F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
    right = F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)
    return left + right


def _shares(counts: Column, total: Column) -> Column:
    """Shares of a total; those of an empty one are not looked at."""
    return F.transform(counts, lambda c: c / F.greatest(total, F.lit(1.0)))


def _distance(p: Column, total: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of the shares ``p`` of ``total`` from reference shares; NULL if empty.

    What is left of either is one more bin.
    """
    rest = lambda x: F.greatest(1.0 - F.aggregate(x, F.lit(0.0), lambda a, y: a + y), F.lit(0.0))
    bins = F.aggregate(F.zip_with(p, shares, _pair), F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.sqrt(F.greatest((bins + _pair(rest(p), rest(shares))) / 2, F.lit(0.0))))


def _verdicts(docs: DataFrame, common: int) -> DataFrame:
    """The columns of ``docs`` in ``row``, then MEASURES."""
    refs = references(docs, common)
    common_words = [r[0] for r in refs.select(F.explode("ref.words")).distinct().collect()]
    # Only spares counting: what is in no reference cannot be a hit.
    everything = sorted({f for w in common_words for f in (w, w.capitalize(), w.upper())})
    lang = F.coalesce(F.col("row.lang"), F.lit(""))
    base = measured(docs)
    # Places of the words in the list of their language: numbers compare faster than words.
    place = lambda w: F.array_position("ref.words", F.lower(w))
    counted = base.join(F.broadcast(refs), lang == F.col("ref_lang"), "left").withColumn(
        "hits", F.transform(F.filter("words", lambda w: w.isin(everything)), place)
    )
    length = F.length("body").cast("double")
    n = F.col("n_words").cast("double")
    times = F.transform(
        "ref.words", lambda _, i: F.size("hits") - F.size(F.array_remove("hits", (i + 1).cast("long")))
    )
    known = F.col("ref_lang").isNotNull()
    # Shares are columns of their own, as a distance looks at them twice.
    out = counted.withColumns({"char_p": _shares(F.col("chars"), length), "word_p": _shares(times, n)}).withColumns(
        {
            "char_distance": F.when(known, _distance(F.col("char_p"), length, F.col("ref.chars"))),
            "word_distance": F.when(known, _distance(F.col("word_p"), n, F.col("ref.shares"))),
        }
    )
    length = F.greatest(F.length("body"), F.lit(1)).cast("double")
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    near = (
        (F.coalesce("char_distance", F.lit(0.0)) <= CHAR_LIMIT + CHAR_NOISE / F.sqrt(length))
        & (F.coalesce("word_distance", F.lit(0.0)) <= WORD_LIMIT + WORD_NOISE / F.sqrt(n))
    )
    return out.select(
        "row",
        *MEASURES[:5],
        base_failed().alias("base_failed"),
        "char_distance",
        "word_distance",
        (~base_failed() & near).alias("kept"),
    )


def judged(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """The documents with MEASURES, which replace columns of the same names.

    char_distance and word_distance are NULL where there is nothing to compare.
    """
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in MEASURES]
    return _verdicts(docs, common).select(*own, *MEASURES)


def passing(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """The documents that are kept, with their own columns only.

    Verdicts are stored first: a filter on them would be pushed below all measures, with
    every measure copied into it again and again.
    """
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return stored(_verdicts(docs, common).select("row", "kept"), "quality").where("kept").select(*own)
