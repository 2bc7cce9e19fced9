"""Line-first cleaning: rules are evaluated on every line, the lines that fail
are removed, and a document that loses too much of its text is rejected.

A line is what stands between two ``\\n``; its rules see it with single spaces
for all white space (``[\\x20\\x09-\\x0D]``) and none at its ends; case does not
matter.  Lines
without a word take no part and stay.  A line fails

* ``punctuation``: it does not end in a terminal mark (closing quotes and
  brackets may follow the mark), or more than a tenth of its characters are
  symbols;
* ``navigation``: it consists of menu phrases only, or it has two separators or
  more and at most four words to an item;
* ``boilerplate``: it has at most 25 words and one of the legal, cookie or
  subscription phrases.

All of it is column expressions over one row: no shuffle, no Python.  A null
text counts as empty: it has no words, fails the base rules and stays null in
``cleaned``.  Repeated rows give repeated rows; other input columns are not
read and may have any name; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: the characters and phrases of the rules (the regular expressions
# mean the same to Java and RE2).
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = r"[#*$%&|<>]+"
LINE_SYMBOLS = r"[#*$%&|<>=~^_{}\\]+"
SEPARATORS = "[|»›·•→]"
TERMINAL = [".", "!", "?", ":", ";", "…", "。", "！", "？"]
CLOSING = "\"'”’»)]"
MENU = ("home|menu|log ?in|log ?out|sign in|sign up|register|next|next page|previous|previous page|back to top|top|"
        "skip to content|skip to main content|read more|click here|share|share this|follow us|search|site ?map|"
        "contact|contact us|about|about us|help|faq|archive|categories|tags|comments")
NAVIGATION = f"(?i)^({MENU})([ ,/>-]+({MENU}))*[ .!:>]*\\z"
BOILERPLATE = ("(?i)(^|[^a-z])(all rights reserved|copyright [(]c[)]|copyright ©|copyright [0-9]{4}|© ?[0-9]{4}|"
               "terms of use|terms of service|terms and conditions|privacy policy|cookie policy|uses cookies|"
               "accept cookies|accept all cookies|enable javascript|lorem ipsum|subscribe to our|subscribe to the|"
               "newsletter|powered by|licensed under|unsubscribe)")
RULES = ("punctuation", "navigation", "boilerplate")

#: Runs of white space inside a line that are not one space already.
_RUNS = r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+"
#: Every three-word window of a text whose words are parted by single spaces.
_WINDOW = r"(?<![^ ])(?=([^ ]++ [^ ]++ [^ ]++))"


def _let(value: Column, body) -> Column:
    """``body`` of ``value`` evaluated once per row, whatever the optimizer does."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _matched(text: Column, pattern: str) -> Column:
    """Number of characters that the pattern matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _words(spaced: Column) -> Column:
    """Number of words of a trimmed text whose words are parted by single spaces."""
    return F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1)


def _line(line: Column, spaced: Column) -> Column:
    """text of a line, whether it has a word, its word characters, the rule it fails (or null)."""
    def judged(t: Column) -> Column:
        n_words = _words(t)
        solid = F.length(F.replace(t, F.lit(" "), F.lit("")))
        separators = _matched(t, SEPARATORS)
        menu = t.rlike(NAVIGATION) | (t.rlike(SEPARATORS) & (separators >= 2) & (n_words <= 4 * (separators + 1)))
        ended = F.right(F.rtrim(t, F.lit(CLOSING)), F.lit(1)).isin(TERMINAL)
        bad = (F.when(t == "", F.lit(None)).when(menu, "navigation")
               .when((n_words <= 25) & t.rlike(BOILERPLATE), "boilerplate")
               .when(~ended | (10 * _matched(t, LINE_SYMBOLS) > solid), "punctuation"))
        return F.struct(line.alias("line"), (t != "").alias("full"), solid.alias("chars"), bad.alias("rule"))

    return _let(F.trim(spaced), judged)


def _lines(raw: Column) -> Column:
    return F.zip_with(F.split(raw, "\n"), F.split(F.regexp_replace(raw, _RUNS, " "), "\n"), _line)


def _fails(rule: str):
    return lambda line: line["rule"] == rule


def _repeated_words(spaced: Column) -> Column:
    """Words under three-word windows that occur twice or more.  Equal windows
    become neighbours by a sort; texts without a repeated window skip it."""
    def covered(at: Column) -> Column:
        widths = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1), p + 3) - p))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda a, w: a + w)

    def marked(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (x["w"] == F.coalesce(F.get(s, k - 1)["w"], F.lit("")))
                         | (x["w"] == F.coalesce(F.get(s, k + 1)["w"], F.lit(""))))
        return _let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def counted(w: Column) -> Column:
        order = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_let(order, marked))

    return _let(F.regexp_extract_all(spaced, F.lit(_WINDOW), F.lit(1)), counted)


def clean_lines(docs: DataFrame, max_lost: int = 30, least_words: int = 50, max_repeat: int = 50,
                text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, cleaned (the text without the failing
    lines), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines (with a word), one ``n_<rule>`` per rule, lost_chars, base_failed,
    kept.  Rejected are texts under ``least_words`` words, with more than
    ``max_repeat`` percent of their words in repeated windows, or that lose more
    than ``max_lost`` percent of their word characters."""
    raw = F.coalesce(F.col(text), F.lit(""))
    spaced = F.trim(F.regexp_replace(raw, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "))
    whole = _let(spaced, lambda t: F.struct(
        _words(t).cast("long").alias("n_words"), F.length(F.replace(t, F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        _repeated_words(t).alias("n_repeat_words")))
    base = docs.select(
        F.col(key).alias("doc_id"), F.col(text).alias("text"), whole.alias("whole"),
        _matched(raw, SYMBOLS).cast("long").alias("n_symbols"), _lines(raw).alias("lines"))
    full = F.transform(F.filter("lines", lambda x: x["full"]), lambda x: x["line"])
    failing = F.filter("lines", lambda x: x["rule"].isNotNull())
    staying = F.transform(F.filter("lines", lambda x: x["rule"].isNull()), lambda x: x["line"])
    judged = base.select(
        "doc_id", F.when(F.col("text").isNotNull(), F.array_join(staying, "\n")).alias("cleaned"),
        "whole.n_words", "whole.word_chars", "n_symbols",
        _let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), "whole.n_repeat_words",
        F.size(full).cast("long").alias("n_lines"),
        *[F.size(F.filter("lines", _fails(rule))).cast("long").alias(f"n_{rule}") for rule in RULES],
        F.aggregate(failing, F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("lost_chars"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (100 * F.col("lost_chars") <= max_lost * F.col("word_chars")))


def line_report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per line with a word: doc_id, line number (from 0), the line, its
    word characters and the rule it fails (null: it stays)."""
    lines = _lines(F.coalesce(F.col(text), F.lit("")))
    return (docs.select(F.col(key).alias("doc_id"), F.posexplode(lines).alias("line_no", "x")).where("x.full")
            .select("doc_id", "line_no", "x.line", F.col("x.chars").cast("long").alias("chars"), "x.rule"))
