import pytest

from headstart.operators.schedule import parse_schedule, rate_at, rate_column, schedule_frame


def test_parse_last_duplicate_wins():
    s = parse_schedule("0,0.1|3,0.01|3,0.05|7,0.001")
    assert s == {0: 0.1, 3: 0.05, 7: 0.001}
    assert [rate_at(t, s, 9.0) for t in range(9)] == [0.1] * 3 + [0.05] * 4 + [0.001] * 2


def test_base_rate_before_first_entry():
    assert rate_at(1, {5: 0.2}, 0.01) == 0.01
    assert rate_at(5, {5: 0.2}, 0.01) == 0.2


@pytest.mark.parametrize("bad", ["1,0.1,2", "1", "-1,0.1", "1,0", "x,1"])
def test_parse_rejects(bad):
    with pytest.raises(ValueError):
        parse_schedule(bad)


def test_frame_and_column_agree(spark):
    text = "0,0.1|3,0.01|3,0.05|7,0.001"
    frame = {r.iteration: r.rate for r in schedule_frame(spark, text).collect()}
    assert frame == parse_schedule(text)
    df = spark.range(10).withColumn("rate", rate_column("id", parse_schedule(text), 1.0))
    assert [r.rate for r in df.orderBy("id").collect()] == [rate_at(t, frame, 1.0) for t in range(10)]
