"""License scan: signature rules over words, gated by keywords, overlaps resolved by priority and containment.

A text becomes words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z. Only texts with a keyword (cheap substring tests) are
normalised: every word between two spaces of its own, so that a rule is a plain regular expression over ' word ' tokens. A rule runs
on a text only if its own keyword is in it. Its matches become word intervals by counting the words between them. Of overlapping
detections those contained in a longer one are dropped; of equal intervals the rule of the smallest priority number stays, then the
first by name. The three base phrases are always reported, whatever the rules find.

Null and empty texts have no words and no labels; repeated rows are scanned as rows of their own; other columns are not read.
Everything is built-in functions, one pass over the texts and window sums over the detections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Substrings of lower-cased texts without which no rule can match; 'cc' alone is tested with what follows it.
GATE = ["licen", "reserved", "copyright", "spdx", "domain", "warrant", "permission", "redistribut", "unencumbered", "reproduc", "unauthorized", "applicable"]
GATE_CC = r"cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+(by|0|zero)"

# label -> (words of its name, alternatives separated by |; the keyword is the longest word all alternatives share or the first one)
NAMES = {
    "mit": "mit|expat", "apache-1.1": "apache software", "apache-2.0": "apache", "bsd-2": "bsd 2 clause|simplified bsd|freebsd",
    "bsd-3": "bsd 3 clause|new bsd|modified bsd|revised bsd", "bsd": "bsd|bsd style", "isc": "isc", "zlib": "zlib|zlib libpng", "boost": "boost software|boost",
    "gpl": "gnu general public|gpl|gnu gpl", "lgpl": "gnu lesser general public|gnu library general public|lesser general public|lgpl|gnu lgpl",
    "agpl": "gnu affero general public|affero general public|agpl|gnu agpl", "gfdl": "gnu free documentation|gfdl", "mpl": "mozilla public|mpl",
    "epl": "eclipse public|epl", "cddl": "common development and distribution|cddl", "cpl": "common public|cpl", "eupl": "european union public|eupl",
    "artistic": "artistic|perl artistic", "python": "python software foundation|psf|python", "ruby": "ruby", "php": "php", "ofl": "sil open font|open font|ofl",
    "wtfpl": "do what the fuck you want to public|wtfpl", "unlicense": "unlicense|unlicence", "ms-pl": "microsoft public|ms pl", "ms-rl": "microsoft reciprocal|ms rl",
    "osl": "open software|osl", "afl": "academic free|afl", "ecl": "educational community", "ncsa": "university of illinois ncsa open source|ncsa",
    "postgresql": "postgresql", "openssl": "openssl", "x11": "x11", "vim": "vim", "odbl": "open database|odbl", "odc-by": "open data commons attribution|odc by",
    "pddl": "public domain dedication and|pddl", "cecill": "cecill", "sspl": "server side public|sspl", "busl": "business source|busl|bsl",
    "elastic": "elastic", "commons-clause": "commons clause", "cc0": "cc0|cc zero|creative commons zero", "cc-by": "cc by|creative commons attribution",
    "cc-by-sa": "cc by sa|creative commons attribution sharealike|creative commons attribution share alike",
    "cc-by-nd": "cc by nd|creative commons attribution noderivs|creative commons attribution noderivatives",
    "cc-by-nc": "cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial",
    "cc-by-nc-sa": "cc by nc sa|creative commons attribution noncommercial sharealike", "cc-by-nc-nd": "cc by nc nd|creative commons attribution noncommercial noderivs",
}

# label -> sentences that stand in its text or notice
SENTENCES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy", "the above copyright notice and this permission notice shall be included in all copies"],
    "apache-2.0": ["you may not use this file except in compliance with the license", "unless required by applicable law or agreed to in writing software"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted", "redistributions of source code must retain the above copyright notice",
            "redistributions in binary form must reproduce the above copyright notice"],
    "bsd-3": ["neither the name of the copyright holder nor the names of its contributors may be used"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "zlib": ["this software is provided as is without any express or implied warranty"],
    "gpl": ["this program is free software you can redistribute it and or modify it", "either version 2 of the license or at your option any later version",
            "either version 3 of the license or at your option any later version"],
    "lgpl": ["this library is free software you can redistribute it and or modify it"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license"],
    "boost": ["distributed under the boost software license version 1 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "public-domain": ["released into the public domain", "this work is in the public domain", "dedicated to the public domain"],
    "proprietary": ["no part of this publication may be reproduced", "reproduction without permission is prohibited", "unauthorized copying of this file is strictly prohibited"],
    "warranty": ["the software is provided as is without warranty of any kind", "without even the implied warranty of merchantability"],
}

VERSION = r"(?: version | v )?(?: v?[0-9]+ )?(?: [0-9]+ )?"
LICENSE = "(?: license | licence )"

# template name -> (priority, score, expression around the name N)
TEMPLATES = {
    "spdx": (1, 1.0, " spdx  license  identifier N" + VERSION),
    "grant": (2, 0.95, "(?: licensed | licenced )(?: under )(?: the  terms  of )?(?: the | a | an )?N" + LICENSE + "?" + VERSION),
    "release": (2, 0.95, "(?: released | distributed | available | published )(?: under )(?: the  terms  of )?(?: the | a | an )?N" + LICENSE + VERSION),
    "title": (3, 0.8, "(?: the )?N" + LICENSE + VERSION),
    "use": (4, 0.9, "(?: subject  to | governed  by | covered  by | according  to )(?: the  terms  of )?(?: the )?N" + LICENSE + VERSION),
}
SENTENCE = (2, 0.9)
BASE_RULE = (5, 0.6)


def phrase(words: str) -> str:
    return "".join(f" {w} " for w in words.split())


def rules() -> list[tuple[str, str, int, float, str, str]]:
    """(rule, label, priority, score, keyword, expression), base phrases first."""
    out = [(f"base:{label}", label, *BASE_RULE, phrase(p), phrase(p)) for p, label in BASE.items()]
    for label, names in NAMES.items():
        each = sorted(names.split("|"), key=lambda n: (-len(n), n))
        shared = set.intersection(*(set(n.split()) for n in each))
        keyword = phrase(max(sorted(shared), key=len)) if shared else ""
        any_name = "(?:" + "|".join(phrase(n) for n in each) + ")"
        out += [(f"{t}:{label}", label, p, s, keyword, e.replace("N", any_name)) for t, (p, s, e) in TEMPLATES.items()]
    out += [(f"text:{label}:{i}", label, *SENTENCE, phrase(max(x.split(), key=len)), phrase(x)) for label, xs in SENTENCES.items() for i, x in enumerate(xs)]
    return out


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _gated(text: Column) -> Column:
    def any_word(x: Column) -> Column:
        hit = x.contains("cc") & x.rlike(GATE_CC)
        for g in GATE:
            hit = x.contains(g) | hit
        return hit
    return _let(F.lower(text), any_word)


def _token_count(s: Column) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))) / 2


def words_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id, n_words and, for texts that pass the keyword gate, the normalised words (else null). Stored once."""
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), t.alias("t"))
    d = d.withColumn("w", F.array_remove(F.split("t", SEPARATORS), ""))
    norm = F.concat(F.lit(" "), F.translate(F.array_join("w", "  "), UPPER, LOWER), F.lit(" "))
    return materialise(d.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.when(_gated(F.col("t")), norm).alias("norm")), "license_words")


def detections(words: DataFrame) -> DataFrame:
    """row, rule, label, priority, score, start, end (words, end exclusive), kept (survives suppression)."""
    names = ["rule", "label", "priority", "score", "keyword", "expression"]
    table = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rules()))
    hit = F.filter(table, lambda r: F.col("norm").contains(r["keyword"]))
    found = words.where("norm is not null").select("row", "norm", F.explode(hit).alias("r"))
    found = found.select("row", "r.rule", "r.label", "r.priority", "r.score",
                         F.split("norm", F.col("r.expression"), -1).alias("gaps"), F.regexp_extract_all("norm", F.col("r.expression"), F.lit(0)).alias("hits"))
    each = found.where(F.size("hits") > 0).select(
        "row", "rule", "label", "priority", "score", F.posexplode(F.arrays_zip(F.slice("gaps", 1, F.size("hits")).alias("gap"), F.col("hits").alias("hit"))).alias("i", "m"))
    each = each.select("row", "rule", "label", "priority", "score", "i", _token_count(F.col("m.gap")).cast("long").alias("gap"), _token_count(F.col("m.hit")).cast("long").alias("size"))
    so_far = Window.partitionBy("row", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).withColumn("start", F.col("end") - F.col("size"))
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("end").over(before) >= F.col("end"), F.lit(False))
    return placed.select("row", "rule", "label", "priority", "score", "start", "end", (~covered).alias("kept"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(words_of(docs), detections)."""
    words = words_of(docs, id_col, text_col)
    return words, detections(words)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns for every document. Score: the largest score of a surviving detection or base phrase, else 0."""
    words, found = scan(docs, id_col, text_col)
    is_base = F.col("rule").startswith("base:")
    listed = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")  # noqa: E731  labels are a fixed list
    per_row = found.where(is_base | F.col("kept")).groupBy("row").agg(
        F.sum(is_base.cast("long")).alias("n_base"), F.min(F.when(is_base, F.col("start"))).alias("first_word"), F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        listed(F.when(is_base, F.col("label"))).alias("base_labels"), listed(F.col("label")).alias("labels"), F.max("score").alias("score"))
    return words.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def oracle_sql() -> str:
    """DuckDB SQL for report(): the same rule table, positions by a list of gaps and matches."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    table = ",\n".join(f"({quoted(r)}, {quoted(lb)}, {p}, {s}e0, {quoted(k)}, {quoted(e)})" for r, lb, p, s, k, e in rules())
    sep = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""
with rules(rule, label, priority, score, keyword, expression) as (values {table}),
d as (select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{sep}'), lambda x: x <> '') as w from documents),
n as (select r, doc_id, len(w)::bigint as n_words, ' ' || array_to_string(w, '  ') || ' ' as norm from d),
f as (select r, rule, label, priority, score, string_split_regex(norm, expression) as gaps, regexp_extract_all(norm, expression) as hits
      from n join rules on contains(norm, keyword) where regexp_matches(norm, expression)),
m as (select r, rule, label, priority, score, unnest(range(1, len(hits) + 1)) as i, gaps, hits from f),
s as (select r, rule, label, priority, score, i, (length(gaps[i]) - length(replace(gaps[i], ' ', ''))) / 2 as gap, (length(hits[i]) - length(replace(hits[i], ' ', ''))) / 2 as size from m),
p as (select *, (sum(gap + size) over (partition by r, rule order by i))::bigint as stop from s),
q as (select *, (stop - size)::bigint as start from p),
k as (select *, coalesce(max(stop) over (partition by r order by start, stop desc, priority, rule rows between unbounded preceding and 1 preceding) >= stop, false) as covered from q),
g as (select r, count(*) filter (rule like 'base:%') as n_base, min(start) filter (rule like 'base:%') as first_word, max(start) filter (rule like 'base:%') as last_word,
      string_agg(distinct label, ',' order by label) filter (rule like 'base:%') as base_labels, string_agg(distinct label, ',' order by label) as labels, max(score) as score
      from k where rule like 'base:%' or not covered group by r)
select doc_id, n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       coalesce(score, 0e0) as score
from n left join g using (r)"""
