import json

import pytest

from larkspur.operators import requests as rq

NAMES = ["id", "t", "x"]


def asked(spark, *bodies):
    return spark.createDataFrame([(str(i), kind, body) for i, (kind, body) in enumerate(bodies)], rq.REQUEST)


def csv_rows(spark, body):
    got = rq.parse_csv(asked(spark, (rq.CSV, body)), NAMES).orderBy("row_no").collect()
    return [tuple(r)[2:] for r in got]


def test_csv_bodies(spark):
    assert csv_rows(spark, "id,t,x\n1,a,2") == [("1", "a", "2")]
    assert csv_rows(spark, "x,id\r\n2,1\r\n\r\n4,3\r\n") == [("1", None, "2"), ("3", None, "4")]
    assert csv_rows(spark, 'id,t,x\n1,"a, ""b""",2\n') == [("1", 'a, "b"', "2")]
    assert csv_rows(spark, 'id,t,x\n1,"two\nlines",2\n3,c,4') == [("1", "two\nlines", "2"), ("3", "c", "4")]
    assert csv_rows(spark, "id,t,x\n,,\n1") == [(None, None, None), ("1", None, None)]
    assert csv_rows(spark, '"id","t"\n1,NA') == [("1", None, None)]


def test_long_csv_body(spark):
    lines = ["id,t,x"] + [f'{i},"text, {i}",{i}.5' for i in range(20000)]
    assert len(csv_rows(spark, "\n".join(lines))) == 20000


@pytest.mark.parametrize("body, rows", [
    ('{"instances": [[1, 2], [3, 4]]}', [[1.0, 2.0], [3.0, 4.0]]),
    ('{"data": [[1.5, 2e1]]}', [[1.5, 20.0]]),
    ('{"instances": [[1]], "data": [[2]]}', [[1.0]]),
    ('{"b": 2, "a": 1}', [[2.0, 1.0]]),
    ("[[1, 2]]", [[1.0, 2.0]]),
])
def test_json_shapes(spark, body, rows):
    requests = asked(spark, (rq.JSON, body))
    assert [r.features for r in rq.parse_json(requests).orderBy("row_no").collect()] == rows
    assert rq.bad_requests(requests).isEmpty()


@pytest.mark.parametrize("kind, body, reason", [
    (rq.JSON, "[1, 2]", "unsupported JSON"),
    (rq.JSON, "5", "unsupported JSON"),
    (rq.JSON, '"text"', "unsupported JSON"),
    (rq.JSON, "{}", "unsupported JSON"),
    (rq.JSON, '{"instances": [1]}', "unsupported JSON"),
    (rq.JSON, '{"a": "word"}', "unsupported JSON"),
    (rq.JSON, "not json", "unsupported JSON"),
    (rq.JSON, None, "unsupported JSON"),
    ("image/png", "x", "unsupported content type"),
    (None, "x", "unsupported content type"),
    (rq.CSV, "id,t,x", "no rows"),
])
def test_bad_requests(spark, kind, body, reason):
    requests = asked(spark, (kind, body))
    assert [r.reason for r in rq.bad_requests(requests).collect()] == [reason]
    assert rq.parse_json(requests).isEmpty() and rq.parse_csv(requests, NAMES).isEmpty()


def test_answers(spark):
    df = spark.createDataFrame([("a", 2, 0), ("a", 1, 1), ("b", 1, 1)], "request_id string, row_no int, prediction int")
    got = dict(map(tuple, rq.answers(df).collect()))
    assert got == {"a": json.dumps({"predictions": [1, 0]}), "b": json.dumps({"predictions": [1]})}
    assert dict(map(tuple, rq.answers(df, rq.CSV).collect())) == {"a": "1,0", "b": "1"}
    with pytest.raises(ValueError):
        rq.answers(df, "image/png")


def test_replay_and_back(spark):
    rows = [("1", 'q"uote', None), ("2", "com,ma", "line\nbreak"), ("3", " pad ", "x")]
    df = spark.createDataFrame(rows, "id string, t string, x string")
    sent = rq.replay(df, "id", NAMES)
    assert sorted(tuple(r)[2:] for r in rq.parse_csv(sent, NAMES).collect()) == rows
    bare = rq.replay(df, "id", ["t", "x"], header=False).where("request_id = '3'").first().body
    assert bare == " pad ,x"


def test_wrong_width(spark):
    requests = asked(spark, (rq.JSON, "[[1, 2]]"), (rq.JSON, "[[1]]"))
    assert [r.request_id for r in rq.wrong_width(requests, 2).collect()] == ["1"]


def test_long_fields_and_open_quotes(spark):
    long = "x" * 50_000
    assert csv_rows(spark, f'id,t,x\n1,"{long}""{long}",2') == [("1", f'{long}"{long}', "2")]
    requests = asked(spark, (rq.CSV, 'id,t\n1,"x\n2,y\n'), (rq.CSV, "id,t\n1,2"), (rq.JSON, "[[1, 2, 3]]"), (rq.JSON, "[[1], [1, 2, 3]]"),
                     (rq.CSV, "x,t,id\n1,2,3"))
    reasons = dict(map(tuple, rq.bad_requests(requests, NAMES).collect()))
    assert reasons == {"0": "open quote", "1": "missing columns", "3": "wrong number of features"}
    assert rq.parse_csv(requests.where("request_id = '0'"), NAMES).isEmpty()
