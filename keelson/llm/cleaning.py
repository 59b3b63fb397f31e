"""Quality rules, line first: every line is judged by itself, failing lines go, and a document
that loses too much of its text goes as a whole. DataFrame functions only, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import count_of, let, strip, whole, words
from .tables import fresh

# The characters the document-level count regards as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Thresholds; shares are of the line's words unless said otherwise."""

    separators: str = "|»›•"                   # navigation bars
    min_separators: int = 3
    separator_share: float = 0.25
    symbol_share: float = 0.5
    shout_share: float = 0.5                  # exclamation and question marks
    boilerplate: str = (r"(?i)\b(cookie (policy|settings|preferences)|accept (all )?cookies|privacy policy|"
                        r"terms of (use|service)|enable javascript|javascript is (disabled|required)|"
                        r"subscribe to our|sign up for our|click here to|back to top|skip to (main )?content|"
                        r"share (this )?on (facebook|twitter|linkedin))\b")
    boilerplate_words: int = 20               # only lines up to this length can be boilerplate
    boilerplate_chars: int = 200
    min_words: int = 20
    repeat_percent: int = 30
    kept_share: float = 0.5                   # of the characters in lines that have a word


def repeated_words(ws: Column) -> Column:
    """How many words lie in an 8-word window that occurs twice or more in ``ws``.

    Windows are compared by 64-bit hash. Equal ones meet by sorting (hash, start), so the
    cost is n log n also for a text that is one phrase over and over."""
    n = 8

    def joined(h: Column, k: int) -> Column:
        """Hashes of windows of ``2 k`` words from those of ``k`` words."""
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + k)))

    grams = let(F.transform(ws, lambda w: F.xxhash64(w)), lambda a: let(joined(a, 1), lambda b: let(
        joined(b, 2), lambda c: F.slice(joined(c, 4), 1, F.greatest(F.size(c) - (n - 1), F.lit(0))))))

    def covered(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, k, h: F.coalesce(F.get(s, k)["h"] == h, F.lit(False))
        twice = let(pairs, lambda s: F.filter(s, lambda x, k: same(s, k - 1, x["h"]) | same(s, k + 1, x["h"])))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, k: F.least(F.lit(n), F.coalesce(F.get(s, k + 1) - p, F.lit(n)))),
            F.lit(0), lambda a, b: a + b))

    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))


def line_fails(line: Column, rules: LineRules) -> Column:
    """True for a line with words that breaks a punctuation, navigation or boilerplate rule."""
    def marked(t: Column) -> Column:
        """The rules that count marks; only lines that hold one need their words counted."""
        def judged(n: Column) -> Column:
            bars, shouts, symbols = count_of(t, rules.separators), count_of(t, "!?"), count_of(t, SYMBOLS)
            return (((bars >= rules.min_separators) & (bars > n * rules.separator_share))
                    | ((shouts >= 3) & (shouts > n * rules.shout_share))
                    | ((symbols >= 3) & (symbols > n * rules.symbol_share)))
        return t.rlike(r"[|»›•!?#*$%&<>]") & let(F.size(words(t)), judged)

    def judged(t: Column) -> Column:
        boilerplate = ((F.char_length(t) <= rules.boilerplate_chars) & t.rlike(rules.boilerplate)
                       & (F.size(words(t)) <= rules.boilerplate_words))
        return marked(t) | boilerplate
    return let(strip(line), lambda t: (t != "") & judged(t))


def report(text: str = "text", rules: LineRules = LineRules()) -> Column:
    """The struct of ``quality_report``."""
    body = whole(text)
    lines = F.split(body, "\n", -1)
    with_word = lambda ls: F.filter(ls, lambda x: strip(x) != "")
    chars = lambda ls: F.aggregate(ls, F.lit(0), lambda a, x: a + F.char_length(x))

    counts = let(words(body), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        repeated_words(ws).cast("long").alias("n_repeat_words")))
    spoken = let(with_word(lines), lambda ls: let(
        F.filter(ls, lambda x: ~line_fails(x, rules)), lambda good: F.struct(
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(good)).cast("long").alias("n_failed_lines"),
            chars(ls).cast("long").alias("line_chars"),
            chars(good).cast("long").alias("kept_chars"))))

    def verdict(c: Column, s: Column) -> Column:
        base = (c["n_words"] < rules.min_words) | (100 * c["n_repeat_words"] > rules.repeat_percent * c["n_words"])
        enough = s["kept_chars"] >= s["line_chars"] * rules.kept_share
        cleaned = F.when(s["n_failed_lines"] == 0, F.col(text)).otherwise(
            F.array_join(F.filter(lines, lambda x: ~line_fails(x, rules)), "\n"))
        return F.struct(
            c["n_words"].alias("n_words"),
            c["word_chars"].alias("word_chars"),
            count_of(body, SYMBOLS).cast("long").alias("n_symbols"),
            s["n_dup_lines"].alias("n_dup_lines"), c["n_repeat_words"].alias("n_repeat_words"),
            s["n_lines"].alias("n_lines"), s["n_failed_lines"].alias("n_failed_lines"),
            s["line_chars"].alias("line_chars"), s["kept_chars"].alias("kept_chars"),
            base.alias("base_failed"), (~base & enough).alias("kept"), cleaned.alias("cleaned"))

    return let(counts, lambda c: let(spoken, lambda s: verdict(c, s)))


def quality_report(docs: DataFrame, text: str = "text", rules: LineRules = LineRules(), name: str = "quality") -> DataFrame:
    """All columns of ``docs`` plus the struct ``name``: counts, ``base_failed``, ``kept``,
    ``cleaned`` (the text without its failing lines, unchanged if none fails).

    A null text counts as empty: no words, fails the base rule, not kept, ``cleaned`` null.
    Lines without a word never fail and are kept as separators. Each row is judged by itself,
    so repeated rows get equal results; an empty table gives an empty result. A column of that
    name is replaced."""
    return docs.withColumn(name, report(text, rules))


def clean(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with the columns of ``docs`` and the cleaned text."""
    name = fresh(docs, "quality")
    columns = [F.col(name)["cleaned"].alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    # The verdict comes out of a generator: a filter on it cannot move below, where it would be computed again.
    kept = F.filter(F.array(report(text, rules)), lambda q: q["kept"])
    return docs.select("*", F.explode(kept).alias(name)).select(*columns)
