"""Document quality: counts of words, symbols and repeats, and distance of a text's histograms from its language's.

All of it is column expressions. One pass keeps a few dozen counts per row in the shared folder; language references are sums
of them over all rows of a language, and each row is then compared with its language's reference. The list of common words
covers four languages; for any other one nearly all words are in the last bin, so only its character classes tell rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from layerlint.session import prepare, written

SPACE = r"[\x20\x09-\x0D]+"
#: frequent words of a few languages; a word may belong to several of them
COMMON_WORDS = (
    "the of and to in is that for it was with as on be at by this are or from "
    "de la le les et des en un une du que pour dans qui sur par plus pas au "
    "der die und den von zu das mit sich ist im dem nicht ein eine auf für "
    "el los las y se del por con una su para es lo como"
).split()
WORDS = list(dict.fromkeys(COMMON_WORDS))
CLASSES = ("vowels", "consonants", "spaces", "other_letters", "digits", "rest")
LEAST_CHARS, LEAST_WORDS = 200, 50
MOST_CHARS, MOST_WORDS = 0.05, 0.20


def words_of(text: Column) -> Column:
    inside = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(inside == "", F.array().cast("array<string>")).otherwise(F.split(inside, SPACE))


def with_class_counts(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Code points of a text per class of ``CLASSES``: what is left gets shorter with each class taken out."""
    left, sizes = F.lower(text), []
    for k, part in enumerate(("aeiou", "[a-z]+", SPACE, r"\p{L}+", "[0-9]+")):
        rows = rows.withColumn(f"__left{k}", left)
        left = F.col(f"__left{k}")
        after = F.regexp_replace(left, part, "")
        if k == 0:  # single letters are faster one by one
            after = left
            for letter in part:
                after = F.replace(after, F.lit(letter), F.lit(""))
        sizes.append(F.length(left))
        left = after
    rows = rows.withColumn("__left5", left)
    sizes.append(F.length("__left5"))
    return rows.withColumn(out, F.array(*[a - b for a, b in zip(sizes, sizes[1:])], sizes[-1])).drop(*[f"__left{k}" for k in range(6)])


def _either(words: list[str]) -> str:
    """A pattern for one of the words, by first letter."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{h}(?:{'|'.join(sorted(rest, key=len, reverse=True))})" for h, rest in sorted(heads.items()))


def with_common_word_counts(rows: DataFrame, text: str, n_words: str, out: str) -> DataFrame:
    """How often each of ``WORDS`` occurs, lower-cased, and last how many other words there are."""
    # the space after a word is not taken, so it can stand before the next one
    found = F.regexp_extract_all(F.concat(F.lit(" "), F.lower(text)), F.lit(rf"[ \t-\r]({_either(WORDS)})(?![^ \t-\r])"), F.lit(1))
    rows = rows.withColumn("__found", F.array_join(found, "  ")).withColumn("__found", F.concat(F.lit(" "), "__found", F.lit(" ")))
    size = F.octet_length("__found")
    counts = F.transform(F.lit(WORDS), lambda w: (
        (size - F.octet_length(F.replace(F.col("__found"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2)).cast("int"))
    rows = rows.withColumn("__counts", counts)
    return rows.withColumn(out, F.concat("__counts", F.array((F.col(n_words) - F.aggregate("__counts", F.lit(0), lambda s, v: s + v)).cast("int")))).drop("__found", "__counts")


FEW = 32  # repeated windows that are looked up one by one


def with_repeated_words(rows: DataFrame, words: str, out: str) -> DataFrame:
    """Words inside three-word windows that the text has twice or more."""
    windows = F.when(F.size(words) >= 4, F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("__windows", windows)
    rows = rows.withColumn("__sorted", F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.sort_array("__windows")))
    twice = F.filter("__sorted", lambda x, k: F.get("__sorted", k + 1) == x)  # equal windows are neighbours once sorted
    rows = rows.withColumn("__twice", F.array_distinct(twice))

    def covered(starts: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    looked_up = F.filter(F.transform("__windows", lambda h, i: F.when(F.array_contains("__twice", h), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("__placed", F.when(F.size("__twice") > FEW, F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(F.get("__placed", k)["h"] == x["h"], F.lit(False))
    merged = F.transform(F.filter("__placed", lambda x, k: ((k > 0) & same(x, k - 1)) | same(x, k + 1)), lambda x: x["i"])
    total = F.when(F.col("__sorted").isNull(), 0).when(F.size("__twice") > FEW, covered(merged)).otherwise(covered(looked_up))
    return rows.withColumn(out, total.cast("bigint")).drop("__windows", "__sorted", "__twice", "__placed")


def with_duplicate_lines(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Lines with a word that equal an earlier line."""
    rows = rows.withColumn("__lines", F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != ""))
    return rows.withColumn(out, (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint")).drop("__lines")


def jensen_shannon(p: Column, q: Column) -> Column:
    """Divergence, 0 to 1, of two arrays of counts; null if either is all zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    term = lambda v, m: F.when(v > 0, v * F.log2(v / m)).otherwise(0.0)

    def divergence(sums: Column) -> Column:
        a, b = F.transform(p, lambda v: v / sums["p"]), F.transform(q, lambda v: v / sums["q"])
        terms = F.zip_with(a, b, lambda x, y: (term(x, (x + y) / 2) + term(y, (x + y) / 2)) / 2)
        return F.when((sums["p"] > 0) & (sums["q"] > 0), F.least(F.greatest(total(terms), F.lit(0.0)), F.lit(1.0)))

    # totals are bound once: inside the lambdas over the counts they would be summed again for each count
    return F.transform(F.array(F.struct(total(p).alias("p"), total(q).alias("q"))), divergence)[0]


def judge(
    docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ("doc_id",),
    most_chars: float = MOST_CHARS, most_words: float = MOST_WORDS, least_chars: int = LEAST_CHARS, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per row: ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, jsd_chars, jsd_words.

    A text fails the base rules with under 50 words or with more than half of its words in repeated windows. It is kept if it
    does not fail them and its character classes and common words diverge from its language's by at most the limits. A
    histogram of fewer than ``least_chars`` characters or ``least_words`` words is not held against a text. A null language is
    a language of its own. Null texts are empty; repeated rows are judged each; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, F.col(lang).alias("__lang"), body.alias("__text")).withColumn("__words", words_of(F.col("__text")))
    rows = rows.withColumn("n_words", F.size("__words").cast("bigint")).withColumn("word_chars", F.length(F.array_join("__words", "")).cast("bigint"))
    rows = rows.withColumn("n_symbols", (F.length("__text") - F.length(F.regexp_replace("__text", r"[#*$%&|<>]+", ""))).cast("bigint"))
    rows = with_repeated_words(rows, "__words", "n_repeat_words").drop("__words")
    rows = with_duplicate_lines(rows, "__text", "n_dup_lines")
    rows = with_common_word_counts(with_class_counts(rows, "__text", "__chars"), "__text", "n_words", "__common")
    counted = written(rows.drop("__text"), "quality-counts")
    sums = [F.array(*[F.sum(F.col(c)[i]).cast("double") for i in range(k)]).alias(f"{c}_all") for c, k in (("__chars", len(CLASSES)), ("__common", len(WORDS) + 1))]
    references = written(counted.groupBy(F.col("__lang").alias("__of")).agg(*sums), "quality-references")
    judged = counted.join(references, F.col("__lang").eqNullSafe(F.col("__of")))
    enough = {"chars": F.aggregate("__chars", F.lit(0), lambda s, v: s + v) >= least_chars, "common": F.col("n_words") >= least_words}
    judged = judged.withColumns({f"__jsd_{c}": F.when(has, jensen_shannon(F.col(f"__{c}"), F.col(f"__{c}_all"))) for c, has in enough.items()})
    chars, common = F.col("__jsd_chars"), F.col("__jsd_common")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.coalesce(chars, F.lit(0.0)) <= most_chars) & (F.coalesce(common, F.lit(0.0)) <= most_words)).alias("kept"),
        chars.alias("jsd_chars"), common.alias("jsd_words"),
    )
