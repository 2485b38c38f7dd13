"""Quality rules as one short-circuit cascade of SQL expressions.

Words are runs of [^\\x20\\x09-\\x0D]; null and empty texts have none. Every rule is a native expression over the text or over
counts of it. plan_cascade() measures, on a sample, how long each rule takes and which share it rejects, and orders the rules by
rejection per cost; the cascade is a CASE WHEN in that order, so a later rule is only evaluated for rows that passed the earlier
ones. The order never changes the verdict: a document is kept when no rule rejects it. Ties in rejection per cost keep the written
order. Repeated rows get equal results; other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PCT = 30
# Fixed values of the added rules: limits in per cent.
SYMBOL_PCT = 20
DUP_LINE_PCT = 30
CAPS_PCT = 50
DIGIT_PCT = 50
SAMPLE_ROWS = 400


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once per row (a lambda variable is never inlined again)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _n_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))


def n_repeat_words(w: Column, window: int = WINDOW) -> Column:
    """Of a word array: words inside windows of `window` words that occur twice or more, the first occurrence included.

    Windows are compared by hashes (64 and 32 bits); a text without repeats costs one hash set, others one sort.
    """
    def covered(at: Column) -> Column:  # sorted starts of repeated windows -> words in their union
        steps = F.transform(at, lambda p, i: F.least(F.lit(window), F.coalesce(F.try_element_at(at, i + 2) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

    def from_sorted(s: Column) -> Column:  # windows ordered by hash: equal neighbours are repeats
        same = lambda a, b: (a["h"] == b["h"]) & (a["g"] == b["g"])
        hit = F.filter(s, lambda x, i: F.coalesce(same(x, F.try_element_at(s, i + 2)), F.lit(False))
                       | F.coalesce(F.when(i > 0, same(x, F.try_element_at(s, F.greatest(i, F.lit(1))))), F.lit(False)))
        return F.when(F.size(hit) == 0, F.lit(0)).otherwise(
            _let(F.sort_array(F.transform(hit, lambda x: x["i"])), covered))

    def hashed(h: Column, i: Column, f=F.xxhash64) -> Column:  # h: word hashes; slice() would copy the whole array each time
        return f(*(F.get(h, i + k) for k in range(window)))

    def repeats(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - window)
        both = F.transform(at, lambda i: F.struct(hashed(h, i).alias("h"), hashed(h, i, F.hash).alias("g"), i.alias("i")))
        distinct = _let(F.transform(at, lambda i: hashed(h, i)), lambda x: F.size(F.array_distinct(x)) == F.size(x))
        return F.when(F.size(h) <= window, F.lit(0)).when(distinct, F.lit(0)).otherwise(_let(F.sort_array(both), from_sorted))

    return _let(F.transform(w, lambda x: F.xxhash64(x)), repeats).cast("long")


def _share(text: Column, chars: Column, of: str, pct: int) -> Column:
    """More than pct per cent of the characters in words are `of`."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{of}]+", ""))) * 100 > chars * pct


# name -> count from (text, word array)
COUNTS = {
    "n_words": lambda t, w: F.size(w).cast("long"),
    "word_chars": lambda t, w: F.length(F.array_join(w, "")).cast("long"),
    "n_symbols": lambda t, w: n_symbols(t),
    "n_dup_lines": lambda t, w: n_dup_lines(t),
    "n_repeat_words": lambda t, w: n_repeat_words(w),
}


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the text and the base counts of every document. The words of a text are split once."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return d.withColumn("words", words(F.col("text"))).select(
        "doc_id", "text", *(f(F.col("text"), F.col("words")).alias(n) for n, f in COUNTS.items()))


def rules(text: Column, have: dict[str, Column]) -> dict[str, Column]:
    """name -> true when the rule rejects. have: the counts, as columns or as expressions that each rule evaluates when reached."""
    return {
        "short": have["n_words"] < MIN_WORDS,
        "repeats": have["n_repeat_words"] * 100 > REPEAT_PCT * have["n_words"],
        "symbols": have["n_symbols"] * 100 > SYMBOL_PCT * have["n_words"],
        "dup_lines": have["n_dup_lines"] * 100 > DUP_LINE_PCT * _n_lines(text),
        "capitals": _share(text, have["word_chars"], "A-Z", CAPS_PCT),
        "digits": _share(text, have["word_chars"], "0-9", DIGIT_PCT),
    }


def _unevaluated(text: Column, split: Column) -> dict[str, Column]:
    return {n: f(text, split) for n, f in COUNTS.items()}


BASE = ("short", "repeats")


def plan_cascade(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds on the sample, share rejected), best rejection per cost first.

    The sample is a random share of the table that holds about `sample_rows` rows; it is stored once and each rule is timed on it.
    It decides the order of the rules and nothing else. An empty sample keeps the written order.
    """
    spark, rows = docs.sparkSession, docs.count()
    x = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    share = min(1.0, sample_rows / max(rows, 1))
    sample = materialise(docs.select(x).sample(False, share, 7).repartition(2), "rule_sample").withColumn("words", words(F.col("text")))
    measured = []
    sample.agg(F.count("*")).first()
    for name, rejects in rules(F.col("text"), _unevaluated(F.col("text"), F.col("words"))).items():
        began = time.perf_counter()
        n, bad = sample.agg(F.count("*"), F.sum(rejects.cast("int"))).first()
        measured.append((name, time.perf_counter() - began, (bad or 0) / max(n, 1)))
    return sorted(measured, key=lambda m: -m[2] / max(m[1], 1e-6))


def first_rejection(order: list[str], rejects: dict[str, Column]) -> Column:
    """Name of the first rule, in the cascade's order, that rejects; null when all pass."""
    chain = None
    for name in order:
        chain = F.when(rejects[name], F.lit(name)) if chain is None else chain.when(rejects[name], F.lit(name))
    return chain


def keep_documents(docs: DataFrame, text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    order = order or [n for n, _, _ in plan_cascade(docs, text_col)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    verdict = _let(words(text), lambda w: first_rejection(order, rules(text, _unevaluated(text, w))))
    return docs.where(verdict.isNull())


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """Counts, base verdict and cascade verdict of every document."""
    order = order or [n for n, _, _ in plan_cascade(docs, text_col)]
    c = counts(docs, id_col, text_col)
    rejects = rules(F.col("text"), {n: F.col(n) for n in COUNTS})
    failed = rejects["short"] | rejects["repeats"]
    rest = first_rejection([n for n in order if n not in BASE], rejects)
    return c.select("doc_id", *COUNTS, failed.alias("base_failed"), F.when(failed, False).otherwise(rest.isNull()).alias("kept"))


# The same report in DuckDB SQL. Windows are compared as texts.
ORACLE_SQL = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select *, list_filter(string_split_regex(t, '{SPACES}'), lambda x: x <> '') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
c as (select *, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
      (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l) as n_lines from w),
x as (select r, unnest(range(1, n_words - {WINDOW} + 2)) as i, w from c where n_words > {WINDOW}),
g as (select r, i, array_to_string(w[i:i + {WINDOW} - 1], ' ') as g from x),
h as (select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
p as (select r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::bigint as n_repeat_words from (select r, i, lead(i) over (partition by r order by i) as nxt from h) group by r),
k as (select c.*, coalesce(p.n_repeat_words, 0)::bigint as n_repeat_words from c left join p using (r)),
v as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PCT} * n_words as base_failed from k)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > {SYMBOL_PCT} * n_words or 100 * n_dup_lines > {DUP_LINE_PCT} * n_lines
            or 100 * (length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g'))) > {CAPS_PCT} * word_chars
            or 100 * (length(t) - length(regexp_replace(t, '[0-9]+', '', 'g'))) > {DIGIT_PCT} * word_chars) as kept
from v"""
