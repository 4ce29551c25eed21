"""Spelling variants by Permuterm rotations (operator 11).

Words get a terminator and all their rotations. Two words that differ in one code point agree
in everything around it, so their rotations that end with that code point have a common prefix;
a word that lacks the code point has this prefix itself as a rotation. Each prefix therefore
names one group: the rotations that go on by one code point (replacements of each other) and
at most one that ends there (the word with the code point left out). Rotations are sorted
under the prefix that skips the edited code point and the groups scanned: a group holds one
word for each letter of the alphabet and one more, so its size is bounded by the alphabet, and
what is emitted is one row a member (number of near words, best near word), never the pairs.

A run of equal letters gives the same shorter word for each of its letters; only its first
letter counts that neighbour.

Words are numbered from the most frequent on (ties in code-point order), so the best near word
is the one with the least number. Prefixes of over ``WHOLE`` code points are named by their
SHA-256, so that a word of n code points costs n small rows; its rotations still take time
in proportion to n * n.

Defined cases: null, empty and letterless texts have no words; a null id is an empty text in
front of the colon; repeated rows count as often as they stand there; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.ranks import numbered
from linclass.llm.text import id_text, scratch_folder, staged

RUN = r"[A-Za-zÀ-ÿ]+"
#: One run in so many, chosen by its document and itself, loses a code point.
DAMAGED = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form is at least so many times as frequent.
FORM_RATIO = 5
TERMINATOR = "\0"
WHOLE = 64


def word_counts(docs: DataFrame, damaged: int = DAMAGED, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of the letter runs of whole texts, lower-cased in A-Z; one run of a
    document in ``damaged`` loses the code point that its checksum points at."""
    rows = id_text(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= least_length)
    ascii_only = F.length("run") == F.octet_length("run")
    runs = rows.select("doc", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", string.ascii_uppercase, string.ascii_lowercase)).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % damaged == 0, F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``key``, ``id`` and ``kind`` for each place of each word: 0 for the whole rotation, 1 and 2
    for the prefix that skips the code point there (1 if the one before it is another)."""
    word, at = F.col("word"), F.col("at")
    head, tail, rest = word.substr(F.lit(1), at), word.substr(at + 1, F.length("word")), word.substr(at + 2, F.length("word"))
    repeated = (at > 0) & (word.substr(at, F.lit(1)) == word.substr(at + 1, F.lit(1)))
    mark = F.lit(TERMINATOR)
    whole = F.struct(F.concat(tail, mark, head).alias("key"), F.lit(0).alias("kind"))
    skip = F.struct(F.concat(rest, mark, head).alias("key"), F.when(repeated, 2).otherwise(1).alias("kind"))
    spun = words.select("id", "word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    keys = spun.select("id", F.inline(F.when(at < F.length("word"), F.array(whole, skip)).otherwise(F.array(whole))))
    return keys.select("id", "kind", F.when(F.length("key") > WHOLE, F.sha2("key", 256)).otherwise(F.col("key")).alias("key"))


def near_words(words: DataFrame) -> DataFrame:
    """``n_near`` and ``best`` (least ``id`` of a near word) of each word that has near words.

    ``words`` has ``id`` (distinct, least is best) and ``word`` (distinct)."""
    groups = rotations(words).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", "kind"))).alias("found")).where(F.size("found") > 1)
    sized = groups.select("found", F.expr("size(filter(found, x -> x.kind = 0))").alias("whole"), F.expr("size(filter(found, x -> x.kind = 1))").alias("first"))
    skips = F.size("found") - F.col("whole")
    members = sized.select("whole", "first", skips.alias("skips"), F.col("found")[0]["id"].alias("id_1"), F.col("found")[1]["id"].alias("id_2"), F.inline("found"))
    near = F.when(F.col("kind") == 0, F.col("first")).when(F.col("kind") == 1, F.col("skips") - 1 + F.col("whole")).otherwise(F.col("skips") - 1)
    best = F.when(F.col("id") == F.col("id_1"), F.col("id_2")).otherwise(F.col("id_1"))
    return members.select("id", near.alias("near"), best.alias("best")).groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best"))


def spelling_variants(counts: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table of distinct ``word`` with their ``n``.

    A form is ``ratio`` times as frequent as its word at least, so a chain of forms has at most
    log(largest n) steps to that base; roots are found by doubling the steps taken so far."""
    spark = counts.sparkSession
    folder = scratch_folder(spark, "variants")
    words = staged(numbered(counts.select("word", F.col("n").cast("long").alias("n")), [F.desc("n"), F.asc("word")], folder, "sorted", "id"), folder, "words")
    near = near_words(words)
    forms = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = words.join(near, "id", "left").join(forms, "best", "left")
    is_form = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    kept = lambda c: F.when(is_form, F.col(c)).alias(c)
    found = staged(found.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("next"), kept("form"), kept("form_n")), folder, "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    steps = found.where("next is not null").select("id", "next")
    for k in range(math.ceil(math.log2(1 + math.log(most, ratio)))):
        onward = steps.select(F.col("id").alias("next"), F.col("next").alias("after"))
        steps = staged(steps.join(onward, "next", "left").select("id", F.coalesce("after", "next").alias("next")), folder, f"steps-{k}")
    roots = steps.select("id", F.col("next").alias("last")).join(words.select(F.col("id").alias("last"), F.col("word").alias("root")), "last").select("id", "root")
    return found.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
