"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space of the word definition [^\\x20\\x09-\\x0D]+, inside a Java character class.
SPACE = r" \t\n\x0B\f\r"
WINDOW = 8
STOP_WORDS = {
    "en": "the of and a in to is was it for with on that as by at from this are be or an have has",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas",
    "es": "de la que el en y a los se del las un por con no una su para es al lo",
}


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= 1000 * part / whole <= high, and always if whole is under `least`."""

    name: str
    part: str
    whole: str
    low: int = 0
    high: int = 1 << 40
    least: int = 1


RULES = (
    Rule("word_length", "word_chars", "n_words", 1500, 25_000),
    Rule("symbols", "n_symbols", "n_words", 0, 100),
    Rule("stop_words", "n_stop_words", "n_words", 20, least=50),
    Rule("distinct_words", "n_distinct_words", "n_words", 250, least=50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0, 300, least=5),
)


def let(value: str, name: str, body: str) -> str:
    """SQL for body with value bound to name, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def repeat_words(words: str, hashes: str) -> str:
    """SQL: words that lie in a window found twice or more. Only texts that have such a window are sorted."""
    covered = let(
        f"sort_array(transform({hashes}, (x, i) -> struct(x AS h, i AS i)))",
        "s",
        "aggregate(sort_array(transform(filter(sequence(0, size(s) - 1), k -> (k > 0 AND s[greatest(k, 1) - 1].h = s[k].h) OR (k < size(s) - 1 AND s[least(k + 1, size(s) - 1)].h = s[k].h)), k -> s[k].i)),"
        f" struct(0L AS n, -{WINDOW} AS last), (a, x) -> struct(a.n + least({WINDOW}, x - a.last) AS n, x AS last), a -> a.n)",
    )
    return f"CASE WHEN size(array_distinct({hashes})) = size({hashes}) THEN 0L ELSE {covered} END"


def passes(rule: Rule) -> Column:
    part, whole = F.col(rule.part) * 1000, F.col(rule.whole)
    return (whole < rule.least) | ((part >= whole * rule.low) & (part <= whole * rule.high))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, least_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """One row for each row of docs: the measures, base_failed, failed_rules and kept.

    A null text counts as empty: it has no words and is not kept. Rows are judged one by one, so repeated ids and other
    columns don't matter. Windows are compared by 64-bit hashes inside one text.
    """
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    bare = F.expr(r"trim(BOTH ' \t\n\u000B\u000C\r' FROM text)")
    out = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = out.withColumns({"words": F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+")), "lines": F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))})
    hashes = f"CASE WHEN size(words) < {WINDOW} THEN array() ELSE transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))) END"
    out = out.withColumns({"hashes": F.expr(hashes)})
    out = out.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeat_words("words", "hashes")).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    out = out.withColumns({"base_failed": failed, "failed_rules": F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]))})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).withColumnRenamed("id", id_col)
