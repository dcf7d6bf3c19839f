"""Nearest term by edit distance, through an index of deletions.

Two strings within k edits share a string that is left of each when at most k characters go.
So terms and asked words meet in an equi-join on those strings, which Spark can split where
one is frequent, and only pairs that meet are measured. No pair within k edits is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from .relational import unique_argmin


def deletions(word: Column, k: int) -> Column:
    """All distinct strings that are left of ``word`` when up to ``k`` characters go."""
    found = step = F.array(word)
    for _ in range(k):
        less = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(w), F.lit(1))), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
        step = F.array_distinct(F.flatten(F.transform(step, less)))
        found = F.array_distinct(F.concat(found, step))
    return found


def near_pairs(words: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """word, term, dist of the pairs of distinct ``words`` (word) and ``terms`` (term) at most ``k`` edits apart."""
    index = terms.select("term").distinct().select("term", F.explode(deletions(F.col("term"), k)).alias("left"))
    asked = words.select("word").distinct().select("word", F.explode(deletions(F.col("word"), k)).alias("left"))
    met = asked.join(index, "left").where(F.abs(F.char_length("word") - F.char_length("term")) <= k).select("word", "term").distinct()
    return met.withColumn("dist", F.levenshtein("word", "term")).where(F.col("dist") <= k)


def nearest(words: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """word and the one term nearest to it, null where the least distance is shared or above ``k``."""
    best = unique_argmin(near_pairs(words, terms, k), ["word"], "dist", "term", k)
    return words.select("word").distinct().join(best, "word", "left")


def with_state(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the code of the state that ``column`` names: exact names and codes by look-up, misspelt ones once for each distinct value."""
    value = F.trim(F.coalesce(F.col(column), F.lit("")))
    low = F.lower(value)
    listed = df.sparkSession.createDataFrame(sorted(P.STATES.items()), "name string, code string")
    codes = sorted(set(P.STATES.values()))
    asked = df.select(value.alias("printed"), low.alias("word")).distinct().where("printed <> ''")
    exact = F.when((F.char_length("printed") == 2) & F.upper("printed").isin(codes), F.upper("printed"))
    name = F.when(F.startswith("word", F.lit("the ")), F.substr("word", F.lit(5)))
    known = asked.join(listed.select(F.col("name").alias("word"), F.col("code").alias("own")), "word", "left").withColumn("bare", F.coalesce(name, F.lit("")))
    known = known.join(listed.select(F.col("name").alias("bare"), F.col("code").alias("of_the")), "bare", "left").withColumn("code", F.coalesce(exact, "own", "of_the"))
    near = nearest(known.where("code is null"), listed.select(F.col("name").alias("term")), 2)
    near = near.join(listed.select(F.col("name").alias("term"), F.col("code").alias("nearest")), "term").select("word", "nearest")
    found = known.join(near, "word", "left").select(F.col("printed").alias("_sl_printed"), F.coalesce("code", "nearest").alias(out))
    return df.join(found, value == F.col("_sl_printed"), "left").drop("_sl_printed")
