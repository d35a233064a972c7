"""Quality rules as a short-circuit cascade, on DataFrame functions only.

A rule is a name and a boolean column that is true where it rejects a document. The cascade
estimates each rule's cost (seconds) and selectivity (share rejected) on a bounded sample and asks
the rules in order of rejection per cost: a row is put to the next rule only if the earlier ones
let it pass. The order decides the work and never the verdict.

Fixed values: words are maximal runs of characters other than blanks ``[\\x20\\x09-\\x0D]``; a
document fails at once with under 50 words, or if over half of its words lie in three-word
windows that its text holds twice.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, SPACE_CHARS, documents

SAMPLE_ROWS = 500
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda s: without(s, SPACE_CHARS) != "")
    return F.struct(F.size(lines).alias("lines"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup"))


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words that lie in ``window``-word windows found at least twice in the text.

    ``words`` must be a column or a bound value, not an expression (the windows index into it). Window starts are sorted by the
    window's words, equal neighbours are kept, and their starts, in text order again, are laid out
    as intervals of ``window`` words whose overlaps count once."""
    n = F.size(words)
    starts = F.when(n >= window, F.sequence(F.lit(0), n - window)).otherwise(F.array().cast("array<int>"))

    def key(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, i + k) for k in range(window)])

    keyed = F.sort_array(F.transform(starts, lambda i: F.struct(key(i).alias("k"), i.alias("at"))))
    pairs = bound(keyed, lambda s: F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda a, b: F.when(
        a["k"] == b["k"], F.array(a["at"], b["at"]))))
    return _covered(F.array_sort(F.array_distinct(F.flatten(F.array_compact(pairs)))), window)


def _covered(starts: Column, window: int) -> Column:
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
        lambda acc, s: F.struct((acc["n"] + F.least(F.lit(window), s - acc["last"])).alias("n"),
                                s.alias("last")),
        lambda acc: acc["n"])


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_q``: n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words (all bigint; 0 for a null or blank text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("_w", words_of(F.col(text_col)))
    # windows that differ throughout need no sorting: most texts
    windows = F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(
        F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))
    rows = rows.withColumn("_h", F.when(F.size("_w") >= 3, windows))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    lines = duplicate_lines(text)
    q = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        F.length(without(text, SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines["lines"].cast("long").alias("n_lines"),
        lines["dup"].cast("long").alias("n_dup_lines"),
        F.when(twice, repeated_words(F.col("_w"))).otherwise(0).cast("long").alias("n_repeat_words"))
    return rows.withColumn("_q", q).drop("_w", "_h")


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (
        100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])


def default_rules(q: Column) -> list[Rule]:
    """Rules over the measures of ``measured``; wide enough for ordinary prose in any language."""
    words = F.greatest(q["n_words"], F.lit(1))
    return [
        Rule("few_words", q["n_words"] < MIN_WORDS),
        Rule("repeated_words", 100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"]),
        Rule("symbols", 10 * q["n_symbols"] > words),
        Rule("duplicate_lines", 2 * q["n_dup_lines"] > q["n_lines"]),
        Rule("word_length", (2 * q["word_chars"] < 5 * words) | (q["word_chars"] > 12 * words)),
    ]


def text_rules(text: Column, words: Column) -> list[Rule]:
    """The same rules straight on a text and its words, each computing only what it needs: what a
    filter uses, where a rule that is not asked is not computed."""
    full = F.coalesce(text, F.lit(""))
    n = F.greatest(F.size(words), F.lit(1))
    chars = F.length(without(full, SPACE_CHARS))
    return [
        Rule("few_words", F.size(words) < MIN_WORDS),
        Rule("repeated_words", 100 * repeated_words(words) > MAX_REPEAT_PERCENT * F.size(words)),
        Rule("symbols", 10 * (F.length(full) - F.length(without(full, SYMBOLS))) > n),
        Rule("duplicate_lines", bound(duplicate_lines(full), lambda s: 2 * s["dup"] > s["lines"])),
        Rule("word_length", (2 * chars < 5 * n) | (chars > 12 * n)),
    ]


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), 0)


def cascade_order(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejection per cost, both estimated on up to ``sample_rows`` rows (the
    first that Spark finds; the order changes the work, not the result). Ties and an empty sample
    keep the rules' own order; rules that nothing in the sample fails go last."""
    text = F.col(text_col)
    names = [r.name for r in text_rules(text, text)]
    sample = docs.select(text_col).limit(sample_rows).persist()
    try:
        total = sample.count()
        rated = []
        for place, name in enumerate(names):
            verdict = bound(words_of(text), lambda w: text_rules(text, w)[place].rejects)
            began = time.perf_counter()
            rejected = sample.agg(F.count_if(F.coalesce(verdict, F.lit(False)))).first()[0]
            cost = time.perf_counter() - began
            rated.append((-rejected / cost, place, name))
    finally:
        sample.unpersist()
    return [r[-1] for r in sorted(rated)] if total else names


def in_order(rules: list[Rule], names: list[str]) -> list[Rule]:
    return sorted(rules, key=lambda r: names.index(r.name))


def first_failed(rules: list[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects the row; null if none does. A rule
    that gives null does not reject."""
    asked = F
    for rule in rules:
        asked = asked.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name))
    return asked.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def judge(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``_q`` (see ``measured``) and ``kept``, the cascade's verdict.

    Null, empty and blank texts have zero words and are rejected; repeated rows are judged alike;
    an empty table stays empty. Column names that start with an underscore are this module's."""
    order = cascade_order(docs, text_col, sample_rows)
    rows = measured(docs, text_col)
    return rows.withColumn("_kept", first_failed(in_order(default_rules(F.col("_q")), order)).isNull())


def keep_good(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the documents that a rule rejects; a rule runs only on rows that the rules
    before it let pass. Columns are those of ``docs``."""
    text, order = F.col(text_col), cascade_order(docs, text_col, sample_rows)
    return docs.where(bound(words_of(text), lambda w: first_failed(in_order(text_rules(text, w), order)).isNull()))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("_q")
    rows = judge(documents(spark, sf_dir).select("doc_id", "text"))
    failed = base_failed(q)
    return rows.select("doc_id", *[q[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"), (~failed & F.col("_kept")).alias("kept"))


OP6_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS s FROM documents),
w AS (
    SELECT doc_id, s,
           [x for x in regexp_split_to_array(s, '[\x20\x09-\x0D]+') if x <> ''] AS w,
           [x for x in string_split(s, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM t),
g AS (
    SELECT *, [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
               for i in range(1, greatest(len(w) - 1, 1))] AS grams
    FROM w),
starts AS (
    SELECT doc_id, s, unnest(grams) AS gram, unnest(range(1, len(grams) + 1)) AS i FROM g),
twice AS (
    SELECT doc_id, s, i FROM starts
    QUALIFY count(*) OVER (PARTITION BY doc_id, s, gram) > 1),
cover AS (
    SELECT doc_id, s, count(DISTINCT i + k) AS n_repeat_words
    FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id, s),
m AS (
    SELECT g.doc_id, len(w)::BIGINT AS n_words,
           length(regexp_replace(g.s, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(g.s) - length(regexp_replace(g.s, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM g LEFT JOIN cover ON g.doc_id = cover.doc_id AND g.s = cover.s),
f AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > greatest(n_words, 1) OR 2 * n_dup_lines > n_lines
            OR 2 * word_chars < 5 * greatest(n_words, 1)
            OR word_chars > 12 * greatest(n_words, 1)) AS kept
FROM f
"""
