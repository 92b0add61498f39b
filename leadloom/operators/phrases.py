"""Ordered rules kept as a table: whole messages and phrases, found by an inverted index.

A rule table has ``rule`` (its number, the least that applies decides), ``phrase`` and
``whole`` (the phrase is the whole text); other columns pass.  A phrase is indexed by
one run of ``GRAM`` of its characters, or itself if it is shorter: by the run that
the fewest phrases hold.  Texts meet phrases in an equi-join on such runs, and each
meeting is checked by ``contains``, so a phrase may start and end inside a word.  The
plan does not depend on the number of rules.

Equal texts are looked up once.  Long texts are read in pieces that overlap.  Case is
left as it is.  Null texts have no rule; null and empty phrases are in no text; a rule may
have several phrases, and repeated rows change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters by which a phrase is indexed, and of a piece of a long text.
GRAM = 6
PIECE = 2_000


def _grams(text: Column, size: int) -> Column:
    """All runs of ``size`` characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def phrase_index(rules: DataFrame) -> DataFrame:
    """``gram``, ``rule`` and ``phrase`` of all rules that are no whole texts."""
    phrases = rules.where(~F.col("whole") & (F.col("phrase") != "")).select("rule", "phrase").distinct()
    size = F.length("phrase")
    grams = F.when(size < GRAM, F.array("phrase")).otherwise(_grams(F.col("phrase"), GRAM))
    each = phrases.select("phrase").distinct().select("phrase", F.explode(F.array_distinct(grams)).alias("gram"))
    held = each.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    chosen = each.join(held, "gram").groupBy("phrase").agg(F.min(F.struct("held", "gram")).alias("key"))
    return phrases.join(chosen, "phrase").select(F.col("key.gram").alias("gram"), "rule", "phrase")


def matches(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct pairs of ``text`` and ``rule`` that applies to it; ``texts`` has a column ``text``."""
    distinct = texts.select("text").where(F.col("text").isNotNull()).distinct()
    index = phrase_index(rules)
    sizes = [r[0] for r in index.select(F.length("gram")).distinct().collect()]  # at most GRAM numbers
    whole = rules.where(F.col("whole") & (F.col("phrase") != "")).select(F.col("phrase").alias("text"), "rule")
    found = distinct.join(whole, "text").select("text", "rule")
    if sizes:
        starts = F.sequence(F.lit(0), F.length("text").cast("int"), F.lit(PIECE))
        pieces = distinct.select(
            "text", F.explode(F.transform(starts, lambda at: F.substring("text", at + 1, F.lit(PIECE + GRAM - 1)))).alias("piece")
        )
        grams = F.array_distinct(F.flatten(F.array(*[_grams(F.col("piece"), s) for s in sorted(sizes)])))
        met = pieces.select("text", F.explode(grams).alias("gram")).join(index, "gram")
        found = found.unionByName(met.where(F.contains("text", "phrase")).select("text", "rule"))
    return found.distinct()


def _with_found(rows: DataFrame, text: str, found: DataFrame, name: str) -> DataFrame:
    """The rows and what was found for their text; ``found`` has one row a text."""
    found = found.select(F.col("text").alias("_found_text"), F.col(name).alias("_found"))
    kept = [F.col(f"`{c}`") for c in rows.columns if c != name]
    return rows.join(found, F.col(f"`{text}`") == F.col("_found_text"), "left").select(*kept, F.col("_found").alias(name))


def with_first_rule(rows: DataFrame, text: str, rules: DataFrame, name: str = "rule") -> DataFrame:
    """Add the least rule that applies to the text, null if none does."""
    found = matches(rows.select(F.col(f"`{text}`").alias("text")), rules)
    return _with_found(rows, text, found.groupBy("text").agg(F.min("rule").alias(name)), name)


def with_all_rules(rows: DataFrame, text: str, rules: DataFrame, name: str = "rules") -> DataFrame:
    """Add all rules that apply to the text in order, null if none does."""
    found = matches(rows.select(F.col(f"`{text}`").alias("text")), rules)
    return _with_found(rows, text, found.groupBy("text").agg(F.sort_array(F.collect_set("rule")).alias(name)), name)


def rule_table(spark, cases) -> DataFrame:
    """A rule table of ``(phrases, whole)`` in their order; rules are numbered from 0."""
    rows = [(number, phrase, whole) for number, (phrases, whole) in enumerate(cases) for phrase in phrases]
    return spark.createDataFrame(rows, "rule int, phrase string, whole boolean")
