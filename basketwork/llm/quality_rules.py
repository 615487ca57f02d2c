"""Line-first cleaning: rules judge each line, then documents that lose too much text go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import has_words, let, words

# Marks of junk, of menus, and phrases of page furniture.
SYMBOLS = "[#*$%&|<>]"
MENU_MARKS = "[|<>]"
BOILERPLATE = (
    "(?i)accept (all )?cookies|enable javascript|terms (of|and) (use|service|conditions)|privacy policy|"
    "all rights reserved|sign (in|up) (to|for)|log ?in to|subscribe to (our|the)|click here|read more|skip to content|"
    "share on (facebook|twitter|linkedin)|lorem ipsum"
)
BOILERPLATE_CHARS = 80
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
MAX_LOST_PERCENT = 30
# Up to so many repeated windows are looked up one by one; texts with more sort their windows.
FEW = 64


def _pairs(values: Column, join) -> Column:
    """`join(a, b)` of each value and the next; the last has null as next."""
    return F.zip_with(values, F.slice(values, 2, F.size(values)), join)


def repeated_words(listed: Column, window: int = 5) -> Column:
    """Words inside `window`-word windows that occur twice or more in the list, the first included.

    Windows are compared by a 64-bit hash. Texts without a repeated window stop at the count of
    distinct hashes. In others the starts of repeated windows are marked, and the covered words
    are the gaps between marked starts, each cut at the window's length.
    """

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(window))))

    def repeated(h: Column) -> Column:
        twice = _pairs(F.sort_array(h), lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.filter(twice, lambda x: x.isNotNull()))

    def starts_of_few(h: Column, r: Column) -> Column:
        at = F.transform(h, lambda x, i: F.when(F.array_contains(r, x), i))
        return F.filter(at, lambda i: i.isNotNull())

    def starts_of_many(h: Column) -> Column:
        def both(s: Column) -> Column:
            ends = _pairs(s, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
            return F.sort_array(F.array_distinct(F.flatten(F.filter(ends, lambda x: x.isNotNull()))))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), both)

    def covered(at: Column) -> Column:
        # the last window has no next one: least() then gives its whole length
        return F.aggregate(_pairs(at, lambda a, b: F.least(b - a, F.lit(window))), F.lit(0), lambda a, gap: a + gap)

    def counted(h: Column) -> Column:
        starts = let(repeated(h), lambda r: F.when(F.size(r) <= FEW, starts_of_few(h, r)).otherwise(starts_of_many(h)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(starts, covered))

    return F.when(F.size(listed) < window, F.lit(0)).otherwise(let(hashes(listed), counted)).cast("long")


def _stutters(w: Column) -> Column:
    """How many words repeat the word before."""
    return F.size(F.filter(_pairs(w, lambda a, b: a == b), lambda same: same))


def _word_chars(line: Column) -> Column:
    return F.length(F.array_join(words(line), "")).cast("long")


def line_fails(line: Column, symbols: Column | None = None, stutters: Column | None = None) -> Column:
    """Whether a line with words breaks a rule.

    Punctuation: junk symbols number over a third of its words. Navigation: menu marks number
    over a fifth of its words. Boilerplate: a line of at most 80 characters holds a phrase of
    page furniture. Stutter: of 4 words or more, over half repeat the word before.
    `symbols` and `stutters` are the counts of the whole document, if known: a line of a document
    without any cannot break those rules, so its words are not split again.
    """
    short = F.length(line) <= BOILERPLATE_CHARS
    count = lambda marks: F.regexp_count(line, F.lit(marks))
    marked = let(F.size(words(line)), lambda n: (count(SYMBOLS) * 3 > n) | (count(MENU_MARKS) * 5 > n))
    stuttering = let(words(line), lambda w: (F.size(w) >= 4) & (_stutters(w) * 2 > F.size(w)))
    if symbols is not None:
        marked = (symbols > 0) & marked
    if stutters is not None:
        stuttering = (stutters > 1) & stuttering
    return (short & line.rlike(BOILERPLATE)) | marked | stuttering


def figures(text: Column) -> Column:
    """struct of the base figures, base_failed, kept, and what `line_fails` needs of the document."""

    def counted(b: Column) -> Column:
        return F.struct(
            b["lines"].alias("lines"), b["n_symbols"].alias("n_symbols"),
            F.size(b["words"]).cast("long").alias("n_words"),
            F.length(F.array_join(b["words"], "")).cast("long").alias("word_chars"),
            (F.size(b["lines"]) - F.size(F.array_distinct(b["lines"]))).cast("long").alias("n_dup_lines"),
            repeated_words(b["words"]).alias("n_repeat_words"), _stutters(b["words"]).alias("stutters"),
        )

    def judged(c: Column) -> Column:
        failed = (c["n_words"] < MIN_WORDS) | (c["n_repeat_words"] * 100 > c["n_words"] * MAX_REPEATED_PERCENT)
        failing = F.filter(c["lines"], lambda line: line_fails(line, c["n_symbols"], c["stutters"]))
        lost = F.aggregate(failing, F.lit(0).cast("long"), lambda a, line: a + _word_chars(line))
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stutters")
        return F.struct(
            *(c[n].alias(n) for n in names), failed.alias("base_failed"),
            (~failed & (lost * 100 <= c["word_chars"] * MAX_LOST_PERCENT)).alias("kept"),
        )

    base = F.struct(
        words(text).alias("words"), F.filter(F.split(text, "\n"), has_words).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    return let(base, lambda b: let(counted(b), judged))


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with _q, their `figures`, per row and without a shuffle.

    The struct comes from a generator of one row, so that filters on it do not compute it again.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("*", F.explode(F.array(figures(text))).alias("_q"))


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the base figures, base_failed and kept of every row.

    A document fails the base with under 10 words or with over 20 % of its words in repeated
    five-word windows. Others are kept unless their failing lines (`line_fails`) hold over 30 %
    of the characters in words. Null and blank texts have no words and fail. Every row gives one
    row, repeated and null ids included; an empty table gives none; columns other than doc_id
    and text are ignored, whatever their names.
    """
    return measured(docs.select("doc_id", "text")).select("doc_id", *(F.col("_q")[c].alias(c) for c in FIGURES))


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that `quality_report` keeps, with all columns and their text without failing lines.

    Lines without words stay. A null n_chars or other column is left as it is; n_chars, if
    present, is the length of the new text.
    """
    rows = measured(docs.select(F.struct("*").alias("_row"), "doc_id", "text")).filter("_q.kept")
    kept = F.filter(
        F.split(F.col("text").cast("string"), "\n"),
        lambda line: ~has_words(line) | ~line_fails(line, F.col("_q.n_symbols"), F.col("_q.stutters")),
    )
    out = rows.withColumn("_text", F.array_join(kept, "\n"))
    columns = {c: F.col("_row")[c] for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(v.alias(c) for c, v in columns.items()))
