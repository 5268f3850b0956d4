import random

from pyspark.sql import functions as F

from lakemart.operators import value_match as V


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def simple(text):
    return " ".join("".join(c if c.isalnum() else " " for c in (text or "").lower()).split())


def edits(n):
    return 2 if n >= 8 else 1 if n >= 4 else 0


def brute(questions, values):
    out = {}
    for q, text in questions.items():
        words = simple(text).split()
        said = {" ".join(words[a : a + n]) for a in range(len(words)) for n in (1, 2, 3) if a + n <= len(words)}
        for v in values:
            t = simple(v)
            found = [d for p in said if t and abs(len(p) - len(t)) <= 2 and (d := distance(p, t)) <= edits(len(t))]
            if found:
                out[q, v] = min(found)
    return out


def tables(spark, questions, values):
    q = spark.createDataFrame(list(questions.items()), "question_id int, question string")
    return q, spark.createDataFrame([("t", "c", v) for v in values], "table_name string, column_name string, value string")


def test_same_as_all_pairs(spark):
    draw = random.Random(4)
    letters = "abcde é"
    values = sorted({"".join(draw.choices(letters, k=draw.randrange(1, 14))) for _ in range(150)} | {"Bank Transfer", "Électronique", "aaaaaaaaaa", "abababab", "--", "ß 1"})
    questions = {}
    for i in range(40):
        words = []
        for _ in range(draw.randrange(1, 6)):
            v = list(draw.choice(values))
            for _ in range(draw.randrange(3)):
                at = draw.randrange(len(v) + 1)
                v[at : at + draw.randrange(2)] = draw.choice([[], ["x"], [draw.choice(letters)]])
            words.append("".join(v))
        questions[i] = draw.choice([" ", ", ", "  "]).join(words)
    questions |= {100: None, 101: "", 102: " ?! ", 103: "BANK  transfr", 104: "aaaaaaaa", 105: "babababa"}
    got = {(r.question_id, r.value): r.distance for r in V.match_values(*tables(spark, questions, values)).collect()}
    assert got == brute(questions, values) and got[103, "Bank Transfer"] == 1


def test_few_pairs_are_compared(spark):
    draw = random.Random(9)
    values = sorted({"".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(2000)})
    questions = {i: v[:3] + v[4:] for i, v in enumerate(values[::10])}
    q, known = tables(spark, questions, values)
    words = V.phrases(q, "question_id", "question")
    compared = V.candidates(words, known.withColumn("text", V.plain(F.col("value")))).count()
    assert compared < 0.1 * len(questions) * len(values)
    found = V.match_values(q, known).where("distance = 1").count()
    assert found >= len(questions)


def test_nothing_to_match(spark):
    q, known = tables(spark, {1: "abc"}, ["abc"])
    assert V.match_values(q.limit(0), known).count() == 0 and V.match_values(q, known.limit(0)).count() == 0


def test_numbered_values_do_not_all_meet(spark):
    """Values that share most of their letters: by pairs of letters most of them were compared."""
    values = [f"Supplier#{i:09d}" for i in range(3000)]
    questions = {i: f"sell of Suplier#{i:09d} in" for i in range(0, 3000, 30)}
    q, known = tables(spark, questions, values)
    words = V.phrases(q, "question_id", "question")
    compared = V.candidates(words, known.withColumn("text", V.plain(F.col("value")))).count()
    assert compared < 0.05 * len(questions) * len(values)
    got = {(r.question_id, r.value): r.distance for r in V.match_values(q, known).collect()}
    assert all(got[i, values[i]] == 1 for i in questions)
    assert len(got) > 10 * len(questions)


def test_long_values_same_as_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(V, "MOST_LETTERS", 6)
    test_same_as_all_pairs(spark)


def test_many_rows_of_few_bytes_are_not_sent_through_the_driver(spark):
    """Questions and values of a few bytes become many rows; only the table of lengths may go to all tasks."""
    values = [f"Supplier#{i:09d}" for i in range(50)] + [f"a name of more than thirty letters {i:03d}" for i in range(50)]
    q, known = tables(spark, {i: f"sell of {v}" for i, v in enumerate(values)}, values)
    found = V.match_values(q, known)
    assert len(found.collect()) >= len(values)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    sent = [line for line in plan.splitlines() if "Broadcast" in line and "Join" in line]
    assert "SortMergeJoin" in plan and all("_length" in line for line in sent)
