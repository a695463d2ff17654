"""Sentiment rules, tables made anew, taxonomies of bots: small cases."""

import pytest

from threadline.operators import segments as sg
from threadline.operators import tables as tb
from threadline.operators import taxonomy as tx


def test_regenerate_survives_a_broken_run(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.regenerate(spark.range(5), path, 1)
    spark.range(2).write.parquet(f"{path}/run=2")  # a second run that broke off before it was listed
    assert tb.generated(spark, path).count() == 5
    tb.regenerate(spark.range(7), path, 2)
    assert tb.generated(spark, path).count() == 7
    tb.regenerate(spark.range(7), path, 2)  # the same run again
    assert tb.generated(spark, path).count() == 7
    assert [p.name for p in (tmp_path / "t").glob("run=*")] == ["run=2"]


def test_bots_fall_back_to_the_user_taxonomy(spark):
    user = spark.createDataFrame([("a", "user a"), ("b", "user b"), ("c", "user c")], "pool string, text string")
    bot = spark.createDataFrame([("a", "bot a"), ("b", ""), ("d", "bot d")], "pool string, text string")
    assert {r.pool: r.text for r in tx.bot_texts(user, bot).collect()} == {"a": "bot a", "b": "user b", "c": "user c", "d": "bot d"}


@pytest.mark.parametrize(("pure", "want"), [(False, [(0.3, "negative"), (1.0, None)]), (True, [(0.3, "negative"), (0.4, "mixed")])])
def test_rules_and_pure_mode(spark, pure, want):
    rows = spark.createDataFrame([(1, True, 0.3, "negative"), (2, False, 0.4, "mixed")], "i long, has_user boolean, confidence double, sentiment string")
    assert [(r.confidence, r.sentiment) for r in sg.adjusted(rows, pure).orderBy("i").collect()] == want


def test_streaks_and_calls_for_a_person(spark):
    moods = ["positive", None, "positive", "negative", "negative", None, "positive"]
    rows = spark.createDataFrame([(1, i, "x" if i != 6 else "fire", m) for i, m in enumerate(moods)], "u long, i long, topic string, sentiment string")
    assert [(r.nth, r.sentiment, r.n) for r in sg.sentiment_streaks(rows, "u", ["i"]).orderBy("nth").collect()] == [(1, "positive", 2), (2, "negative", 2), (3, "positive", 1)]
    assert [(r.i, r.why) for r in sg.needing_a_person(rows, "u", ["i"], ["fire"], ["x"]).orderBy("i").collect()] == [(4, "repeated"), (6, "urgent")]
    falls = [r.i for r in sg.sentiment_trends(rows, "u", ["i"]).where("falling").orderBy("i").collect()]
    assert falls == [3, 4]
