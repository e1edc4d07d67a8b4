import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import weekly
from tidemark.plans import warehouse as wh


def day(text):
    return dt.date.fromisoformat(text)


def history(spark, shares, topic=0):
    start = day("2022-05-02")
    rows = [(topic, start + dt.timedelta(days=7 * i), int(1000 * s), 1000, float(s)) for i, s in enumerate(shares)]
    return spark.createDataFrame(rows, "topic_id int, week_start date, topic_count long, total_complaints long, topic_share double")


RULES = weekly.ScoreRules(lookback_weeks=6, minimum_history_weeks=4, robust_z_threshold=3.0, minimum_weekly_count=40, minimum_share_increase=0.02, scale_floor=0.015)


def test_grid_is_complete_and_shares_sum_to_one(spark):
    rows = [("2022-05-03", 0), ("2022-05-04", 1), ("2022-05-10", 0)]
    df = spark.createDataFrame([(day(d), t) for d, t in rows], "date_received date, topic_id int")
    got = {(r.topic_id, str(r.week_start)): r for r in weekly.grid(df, day("2022-05-02"), day("2022-05-15")).collect()}
    assert len(got) == 4
    assert got[1, "2022-05-09"].topic_count == 0
    assert got[0, "2022-05-02"].topic_share + got[1, "2022-05-02"].topic_share == 1.0


def test_grid_starts_at_first_monday_and_refuses_missing_dates(spark):
    df = spark.createDataFrame([(day("2022-05-04"), 0), (day("2022-05-10"), 0)], "date_received date, topic_id int")
    got = weekly.grid(df, day("2022-05-04"), day("2022-05-15")).collect()
    assert [(str(r.week_start), r.topic_count) for r in got] == [("2022-05-09", 1)]
    bad = spark.createDataFrame([(None, 0)], "date_received date, topic_id int")
    with pytest.raises(ValueError, match="valid date"):
        weekly.grid(bad, day("2022-05-02"), day("2022-05-15"))


def test_persistent_spike_alerts_in_its_second_week(spark):
    got = weekly.scored(history(spark, [0.2] * 7 + [0.45, 0.47]), RULES).orderBy("week_start").collect()
    assert got[7].candidate_signal and not got[7].alert
    assert got[8].alert and got[8].baseline_share_median == pytest.approx(0.2)
    assert got[3].robust_z_score is None and got[3].candidate_signal is False


def test_single_spike_is_a_candidate_without_alert(spark):
    got = weekly.scored(history(spark, [0.25] * 6 + [0.5]), RULES).agg(F.count_if("candidate_signal"), F.count_if("alert")).first()
    assert tuple(got) == (1, 0)


def test_even_history_uses_the_mean_of_the_middle_values(spark):
    got = weekly.scored(history(spark, [0.05, 0.15, 0.35, 0.45, 0.6]), weekly.ScoreRules(lookback_weeks=4, minimum_history_weeks=4, scale_floor=0.01)).orderBy("week_start").collect()[4]
    assert got.baseline_share_median == pytest.approx(0.25)
    assert got.baseline_share_scale == pytest.approx(1.4826 * 0.15)


@pytest.mark.parametrize("bad", [{"lookback_weeks": 3}, {"persistence_required_weeks": 4}, {"scale_floor": 0.0}])
def test_rules_are_checked(bad):
    with pytest.raises(ValueError):
        weekly.ScoreRules(**bad)


def test_terms_are_limited_and_missing_topics_are_null(spark):
    topics = spark.createDataFrame([(0, ["card", "fee", "late"])], "topic_id int, top_terms array<string>")
    rows = spark.createDataFrame([(0,), (1,)], "topic_id int")
    assert {r.topic_id: r.topic_terms for r in weekly.with_terms(rows, topics, 2).collect()} == {0: "card, fee", 1: None}


def test_warehouse_publishes_and_validates(spark):
    facts = spark.createDataFrame([(1, day("2022-05-03"), "a", "x", 0), (2, day("2022-05-04"), "b", "x", 1)], "complaint_id long, date_received date, product string, issue string, topic_id int")
    scores = weekly.scored(weekly.grid(facts, day("2022-05-02"), day("2022-05-08")))
    alerts = weekly.alerts(scores)
    topics = spark.createDataFrame([(0, "t0", 1, "a", 1.0, 1), (1, "t1", 1, "b", 1.0, 1)], "topic_id int, top_terms string, historical_rows long, dominant_product string, dominant_product_share double, product_count long")
    names = wh.publish(spark, {"fact_complaint_topic": facts, "fact_weekly_topic_metric": scores, "fact_risk_alert": alerts, "dim_topic": topics})
    assert spark.table("vw_weekly_topic_dashboard").count() == 2 and "vw_weekly_overview" in names
    window = day("2022-05-02"), day("2022-05-08")
    assert wh.validate(facts, scores, alerts, *window)["complaint_rows"] == 2
    with pytest.raises(ValueError, match="not unique"):
        wh.validate(facts.union(facts), scores, alerts, *window)


def test_text_columns_are_refused(spark):
    df = spark.createDataFrame([("x",)], "complaint_narrative string")
    with pytest.raises(ValueError, match="prohibited"):
        wh.publish(spark, {"fact_complaint_topic": df})


def test_streaming_weeks_begin_on_monday(spark, tmp_path):
    from tidemark.streaming.weekly import append_to, weekly_counts

    rows = [(dt.datetime(2022, 5, 4), 0), (dt.datetime(2022, 5, 8, 23), 0), (dt.datetime(2022, 5, 9), 1), (dt.datetime(2022, 6, 30), 1)]
    spark.createDataFrame(rows, "ts timestamp, topic int").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, topic int").parquet(str(tmp_path / "in"))
    append_to(weekly_counts(stream, "ts", "topic"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = {(r.topic_id, str(r.week_start)): r.topic_count for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[0, "2022-05-02"] == 2 and got[1, "2022-05-09"] == 1
