"""Rules as a table against plain substring tests."""

import random

from pyspark.sql import functions as F

from leadloom.operators import phrases

RULES = "rule int, phrase string, whole boolean"


def test_first_and_all_rules_equal_plain_tests(spark):
    draw = random.Random(4)

    def some(least, most):
        return "".join(draw.choice("ab .é\U0001f600\n") for _ in range(draw.randint(least, most)))

    rules = [(draw.randrange(40), some(0, 9), draw.random() < 0.3) for _ in range(60)] + [(3, None, False), (4, "", False), (5, "", True)]
    rules += rules[:5]
    texts = [some(0, 30) for _ in range(300)] + [None, "", rules[0][1], "a" * 5_000 + some(9, 9) + "b" * 3_000]
    texts += [x * 700 for x in (some(5, 9), some(5, 9))] + texts[:20]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame(rules, RULES)
    first = {r.id: r.rule for r in phrases.with_first_rule(rows, "text", table).collect()}
    every = {r.id: r.rules for r in phrases.with_all_rules(rows, "text", table).collect()}
    assert len(first) == len(every) == len(texts)
    for number, text in enumerate(texts):
        want = sorted({r for r, p, whole in rules if text is not None and p and (p == text if whole else p in text)})
        assert (every[number] or []) == want and first[number] == (want[0] if want else None), text


def test_empty_tables_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "not now", "x")], "id int, text string, rule string")
    none = spark.createDataFrame([], RULES)
    assert [tuple(r) for r in phrases.with_first_rule(rows, "text", none).collect()] == [(1, "not now", None)]
    assert phrases.with_first_rule(rows.where("false"), "text", none).count() == 0


def test_the_plan_does_not_grow_with_the_rules(spark):
    def rules(count):
        spark_rows = spark.range(count).withColumn("rule", F.col("id").cast("int"))
        return spark_rows.select("rule", F.concat(F.lit("item "), "rule", F.lit(" sold")).alias("phrase"), F.lit(False).alias("whole"))

    rows = spark.range(2_000).select("id", F.concat(F.lit("the item "), F.col("id") * 70, F.lit(" sold out")).alias("text"))
    plans = []
    for count in (100, 100_000):
        found = phrases.with_first_rule(rows, "text", rules(count))
        plans.append(len(found._jdf.queryExecution().optimizedPlan().toString()))
        assert found.where("rule = id * 70").count() == found.where("rule is not null").count() == min(2_000, -(-count // 70))
    assert abs(plans[0] - plans[1]) < 50
