"""Which dictionary values a question names, spelling mistakes allowed.

Phrases of a question, runs of one to MAX_WORDS words, are joined with the values by
edit distance.  No phrase meets every value.  Two strings within d edits become equal
when up to d letters are left out of each, so strings of up to MOST_LETTERS letters
meet on what remains: only strings that differ in a few letters do, also where
all values look alike (numbered names).  Longer strings would remain in too many ways.
They are cut into their pairs of neighbouring letters, put in one order (pairs rare
among the values first): an edit spoils at most two pairs, so two strings within
d edits share one of their first 2 d + 1 pairs; only strings that do are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.sources.tables import materialize

MAX_WORDS = 3
# Edits allowed, by the least length of the value; two at most.
ALLOWED = ((8, 2), (4, 1), (0, 0))
PAIR = 2
# Values of more letters are found by their pairs.
MOST_LETTERS = 32


def plain(text: Column) -> Column:
    """Small letters and digits of any script, words one space apart."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def allowed(length: Column) -> Column:
    edits = F.lit(0)
    for least, d in reversed(ALLOWED):
        edits = F.when(length >= least, F.lit(d)).otherwise(edits)
    return edits


def dealt(df: DataFrame, by: str) -> DataFrame:
    """Few bytes that become many rows: dealt to all tasks, which adaptive execution does not merge."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)


def unsent(df: DataFrame) -> DataFrame:
    """Many rows made of few bytes: the planner, which knows the bytes only, would send them through the driver to all tasks."""
    return df.hint("merge")


def phrases(questions: DataFrame, question_id: str, question: str) -> DataFrame:
    """(question, phrase), each once."""
    questions = dealt(questions, question_id)
    words = F.split(plain(F.col(question)), " ")
    cut = questions.where(plain(F.col(question)) != "").select(question_id, words.alias("_words"))
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - 1),
            lambda at: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(MAX_WORDS), F.size("_words") - at)), lambda n: F.array_join(F.slice("_words", at + 1, n), " ")
            ),
        )
    )
    return cut.select(question_id, F.explode(F.array_distinct(runs)).alias("phrase"))


def letter_pairs(text: Column) -> Column:
    """Neighbouring letters with a mark at both ends, equal pairs numbered."""
    marked = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda at: F.substring(marked, at, F.lit(PAIR)))
    before = F.transform(pairs, lambda p, i: F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda x: x == p)))
    return F.zip_with(pairs, before, lambda p, n: F.concat(p, n.cast("string")))


def prefixes(strings: DataFrame, frequency: DataFrame, edits: Column) -> DataFrame:
    """(text, pair): the first ``2 * edits + 1`` pairs of every string."""
    listed = strings.select("text", edits.alias("_edits"), F.explode(letter_pairs(F.col("text"))).alias("pair"))
    order = Window.partitionBy("text").orderBy(F.coalesce("often", F.lit(0)), "pair")
    ranked = unsent(listed).join(unsent(frequency), "pair", "left").withColumn("_at", F.row_number().over(order))
    return ranked.where(F.col("_at") <= PAIR * F.col("_edits") + 1).select("text", "pair")


def remains(strings: DataFrame, edits: Column) -> DataFrame:
    """(text, left_out, rest): what is left of every string without up to ``edits`` of its letters, as a hash."""
    text, places = F.col("text"), F.sequence(F.lit(1), F.length("text"))
    without = lambda s, at: F.concat(F.substring(s, F.lit(1), at - 1), F.substr(s, at + 1))
    hashed = lambda s: F.xxhash64(s)
    # The later letter goes first, so that the place of the earlier one still holds.
    pairs = F.flatten(F.transform(places, lambda i: F.transform(F.filter(places, lambda j: j < i), lambda j: hashed(without(without(text, i), j)))))
    ways = [F.array(hashed(text)), F.transform(places, lambda i: hashed(without(text, i))), pairs]
    none = F.array().cast("array<bigint>")
    listed = F.array(*(F.struct(F.lit(n).alias("left_out"), F.when(edits >= n, F.array_distinct(w)).otherwise(none).alias("rests")) for n, w in enumerate(ways)))
    return dealt(strings, "text").select("text", F.inline(listed)).select("text", "left_out", F.explode("rests").alias("rest"))


def candidates(words: DataFrame, values: DataFrame) -> DataFrame:
    """(phrase, text) of strings that are near enough to be compared and have fitting lengths."""
    texts, said = values.select("text").distinct(), words.select("phrase").distinct()
    most = max(d for _, d in ALLOWED)
    length = F.length("text")
    near = F.abs(F.length("phrase") - length) <= allowed(length)

    # Short values: both sides left out as many letters as the difference in length leaves them.
    short = texts.where(length <= MOST_LETTERS)
    fitting = short.select(F.explode(F.sequence(length - allowed(length), length + allowed(length))).alias("_length")).distinct()
    asked = said.join(F.broadcast(fitting), F.length("phrase") == F.col("_length"), "left_semi").select(F.col("phrase").alias("text"))
    left = remains(asked, allowed(length + most)).toDF("phrase", "_phrase_out", "rest")
    right = remains(short, allowed(length))
    # Where the shorter side could leave out more on both, the same strings meet again there.
    limit = allowed(length)
    full = F.greatest("left_out", "_phrase_out") == limit
    fits = (length - F.length("phrase") == F.col("left_out") - F.col("_phrase_out")) & full
    found = unsent(left).join(unsent(right), "rest").where(near & fits).select("phrase", "text")

    long = texts.where(length > MOST_LETTERS)
    frequency = long.select(F.explode(letter_pairs(F.col("text"))).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("often"))
    asked = said.where(F.length("phrase") > MOST_LETTERS - most).select(F.col("phrase").alias("text"))
    left = prefixes(asked, frequency, F.lit(most)).toDF("phrase", "pair")
    right = prefixes(long, frequency, allowed(length))
    return found.unionByName(unsent(left).join(unsent(right), "pair").where(near).select("phrase", "text")).distinct()


def match_values(questions: DataFrame, values: DataFrame, question_id: str = "question_id", question: str = "question") -> DataFrame:
    """(question, table_name, column_name, value, distance): the values a question names, with the least distance.

    ``values`` is (table_name, column_name, value).  Values without a letter or
    digit are never named, nor is any by an empty or NULL question.
    """
    known = values.select("table_name", "column_name", "value", plain(F.col("value")).alias("text")).where("text != ''")
    # Read several times, and what it is made of is as large as the tables.
    known = materialize(known, "known-values")
    words = phrases(questions, question_id, question)
    edits = allowed(F.length("text"))
    close = candidates(words, known).withColumn("distance", F.levenshtein("phrase", "text")).where(F.col("distance") <= edits)
    return (
        unsent(words).join(unsent(close), "phrase").join(unsent(known), "text")
        .groupBy(question_id, "table_name", "column_name", "value")
        .agg(F.min("distance").alias("distance"))
    )
