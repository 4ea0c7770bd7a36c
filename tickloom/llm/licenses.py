"""Licence scan by ordered signature rules, in DataFrame functions only.

Rules are hand-written regexes over a text's words (A-Z lower-cased, joined by one space); see license_rules. A keyword that
every match contains gates each rule. Every rule has a priority; a detection is suppressed where one of higher or equal
priority contains its interval. One narrow projection does it all: no join, no shuffle. Each regex is a constant of the plan,
so a task compiles it once.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.license_rules import KINDS, signatures

#: The base phrases, in words.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
PRIORITIES = 1 + max(p for p, _ in KINDS.values())
#: Characters that no text of words holds: they mark where a match begins and ends.
_BEGIN, _END = "\\u0001", "\\u0002"

Rule = tuple[str, int, float, str, str]


def rules() -> list[Rule]:
    """(label, priority, weight, keyword, regex), in order. A match begins with the space before its first word."""
    return [(label, *KINDS[kind], keyword, f" (?:{regex})(?= )") for label, kind, keyword, regex in signatures()]


def _spaces(x: str) -> str:
    return f"(length({x}) - length(replace({x}, ' ', '')))"


_SPAN = "struct<start:int,stop:int,priority:int,rule:int,label:string,weight:double>"


def _spans(rows: list[Rule]) -> str:
    """SQL: all places of the rules in _words, ordered by start, longest first, priority and rule.

    A rule whose keyword is there yields the words with its matches marked; a match starts after as many words as spaces are
    before it.
    """
    by: dict[str, list[int]] = {}
    for i, row in enumerate(rows):
        by.setdefault(row[3], []).append(i)
    marked = lambda i: f"struct({i} as rule, regexp_replace(_words, r'({rows[i][4]})', '{_BEGIN}$1{_END}') as words)"
    gated = ", ".join(f"if(contains(_words, '{word}'), array({', '.join(map(marked, numbers))}), null)" for word, numbers in by.items())
    labels, priorities, weights = ("array(" + ", ".join(f"{x!r}" + ("D" if isinstance(x, float) else "") for x in column) + ")" for column in list(zip(*rows, strict=True))[:3])
    hits = f"filter(flatten(filter(array({gated}), x -> x is not null)), r -> contains(r.words, '{_BEGIN}'))"
    one = f"""
  aggregate(split(r.words, '{_BEGIN}'), struct(-1 as at, cast(array() as array<struct<start:int,stop:int>>) as spans),
    (s, part) -> struct(if(s.at < 0, 0, s.at) + {_spaces("part")} as at,
      if(s.at < 0, s.spans, concat(s.spans, array(struct(s.at as start, s.at + {_spaces(f"substring_index(part, '{_END}', 1)")} as stop)))) as spans), s -> s.spans)"""
    every = f"flatten(transform({hits}, r -> transform({one}, z -> struct(z.start as start, -z.stop as back, {priorities}[r.rule] as priority, r.rule as rule, {labels}[r.rule] as label, {weights}[r.rule] as weight))))"
    return f"transform(array_sort({every}), s -> cast(struct(s.start as start, -s.back as stop, s.priority as priority, s.rule as rule, s.label as label, s.weight as weight) as {_SPAN}))"


def _kept(spans: str) -> str:
    """What no earlier span in order of (start, longest, priority) of the same or a higher priority reaches over."""
    reach = ", ".join("-1" for _ in range(PRIORITIES))
    held = " or ".join(f"(s.reach[{p}] >= d.stop and {p} <= d.priority)" for p in range(PRIORITIES))
    new = ", ".join(f"if(d.priority = {p}, greatest(s.reach[{p}], d.stop), s.reach[{p}])" for p in range(PRIORITIES))
    kind = f"array<{_SPAN}>"
    return f"aggregate({spans}, struct(array({reach}) as reach, cast(array() as {kind}) as kept), (s, d) -> struct(array({new}) as reach, if({held}, s.kept, concat(s.kept, array(d))) as kept), s -> s.kept)"


def scan(docs: DataFrame) -> DataFrame:
    """Add n_words, base (places of the base phrases) and found (detections that no better one contains) to documents.

    Both are arrays of (start, stop, priority, rule, label, weight), in words from 0, stop exclusive. Words are runs of other
    than ASCII non-alphanumerics in the whole text, A-Z lower-cased. Null and empty texts have no words and empty arrays.
    Every row is scanned by itself, so repeated rows give repeated results. Columns of docs of the same names are replaced.
    """
    low = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))
    named = docs.drop("n_words", "base", "found").withColumn("_words", words)
    base = [(label, 0, 1.0, phrase, f" {phrase}(?= )") for phrase, label in BASE.items()]
    out = named.withColumn("base", F.expr(_spans(base))).withColumn("_spans", F.expr(_spans(rules()))).withColumn("found", F.expr(_kept("_spans")))
    n_words = F.when(F.length("_words") <= 2, F.lit(0)).otherwise(F.octet_length("_words") - F.octet_length(F.replace("_words", F.lit(" "), F.lit(""))) - 1)
    return out.withColumn("n_words", n_words.cast("long")).drop("_words", "_spans")


def scan_documents(docs: DataFrame) -> DataFrame:
    """The digest of a scan: a row for each document, with labels and the weight of the surest detection as score."""
    out = scan(docs.select("doc_id", "text"))
    labels = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    return out.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        labels(F.col("base.label")).alias("base_labels"),
        labels(F.concat("base.label", "found.label")).alias("labels"),
        F.coalesce(F.array_max(F.concat("base.weight", "found.weight")), F.lit(0.0)).alias("score"),
        F.size("found").cast("long").alias("n_found"),
    )
