import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.json_text import has_keys, is_json_object
from tidemark.operators.decode import decode_changes
from tidemark.operators.filters import require_keys
from tidemark.schema import change_schema
from tidemark.sinks.files import land_text
from tidemark.sources.files import json_rows, text_values

CASES = [
    ('{"eventTime":1,"message":"m"}', True),
    ('{"eventTime":null,"message":null}', True),
    ('{"message":{"a":[1]},"x":0,"eventTime":[]}', True),
    ('{"eventTime":1,"eventTime":2,"message":2}', True),
    ('{"event\\u0054ime":1,"message":2}', True),
    (' {"eventTime":1,\n"message":2} ', True),
    ('{"eventTime":1}', False),
    ('{"message":1}', False),
    ('{"EVENTTIME":1,"message":1}', False),
    ('{"a":{"eventTime":1,"message":2}}', False),
    ('{"eventTime":1,"message":', False),
    ('[{"eventTime":1,"message":2}]', False),
    ("", False),
    (None, False),
    ('"x"', False),
    ("3", False),
    ("null", False),
    ("{}", False),
    ("{'eventTime':1,'message':2}", False),
    ('{"eventTime":1,"message":2,"x":tru}', False),
    ('{"eventTime":1,"message":NaN}', False),
    ("eventTime message", False),
    ('{"eventTime":null,"message":1}', True),
    ('{"eventTime":1,"message":{"a":1,"a":[null]}}', True),
    ('{"eventTime":"null"}', False),
    ('{"eventTime":null,"message":null', False),
    ('{"eventTime":null,"message":null,"x":tru}', False),
    ('[{"eventTime":null,"message":null}]', False),
    ('{"a":{"eventTime":null,"message":null}}', False),
    ('{"eventTime":1,"message":2} trailing', True),
]


def test_required_keys(numbered):
    df = numbered([text for text, _ in CASES])
    kept = {row.n for row in require_keys(df).collect()}
    assert kept == {n for n, (_, wanted) in enumerate(CASES) if wanted}


def test_predicate_is_never_null(numbered):
    df = numbered([text for text, _ in CASES])
    assert df.where(has_keys("value", "eventTime").isNull()).count() == 0


def test_text_is_unchanged(values):
    text = ' {"eventTime" : 1 , "message":"ü\\u00e9"} '
    assert [row.value for row in require_keys(values(text)).collect()] == [text]


def test_other_keys(values):
    df = values('{"a":1}', '{"a":1,"b":2}', '{"b":1}')
    assert require_keys(df, "a").count() == 2
    assert require_keys(df, "a", "b", "a").count() == 1
    with pytest.raises(ValueError):
        has_keys("value")


def test_odd_key_names(values):
    df = values('{"a.b":1,"c`d":null}', '{"a":{"b":1},"c`d":1}')
    assert require_keys(df, "a.b", "c`d").count() == 1


def test_keys_that_differ_by_case(values):
    df = values('{"a":1,"A":null}', '{"a":1}', '{"A":1}')
    assert require_keys(df, "a", "A").count() == 1


def test_parses_do_not_grow_with_the_keys(values):
    df = values("{}").select(F.concat("value", F.lit(" ")).alias("value"))
    for keys in (("a",), ("a", "b", "c")):
        plan = require_keys(df, *keys)._jdf.queryExecution().optimizedPlan().toString()
        condition = plan.split("Filter")[1].splitlines()[0]
        assert condition.count("from_json") == 2  # the asked fields; the key set


def test_against_brute_force(numbered):
    rng = random.Random(7)
    texts = []
    for _ in range(3000):
        names = rng.sample(["eventTime", "message", "other", "Message"], rng.randint(0, 4))
        record = {
            name: rng.choice([None, 1, "null", "", {"message": None}, [None], True]) for name in names
        }
        text = json.dumps(record, separators=rng.choice([(",", ":"), (", ", ": ")]))
        if rng.random() < 0.3:
            text = text[: rng.randrange(len(text) + 1)]
        texts.append(text)

    def expected(text):
        try:
            root = json.loads(text)
        except ValueError:
            return False
        return isinstance(root, dict) and {"eventTime", "message"} <= root.keys()

    kept = {row.n for row in require_keys(numbered(texts)).collect()}
    assert kept == {n for n, text in enumerate(texts) if expected(text)}
    assert len(kept) > 300


def test_is_json_object(numbered):
    df = numbered(["{}", "[]", "1", "x", None])
    assert [r.ok for r in df.select(is_json_object("value").alias("ok")).collect()] == [
        True,
        False,
        False,
        False,
        False,
    ]


@pytest.mark.parametrize(
    "extra", ["[" * 1100 + "]" * 1100, "1" * 1100, '"' + "x" * 21_000_000 + '"', '{"a":null,"b":' + "[" * 1100 + "]" * 1100 + "}"]
)
def test_parser_limits_drop_nothing(spark, tmp_path, extra):
    text = f'{{"eventTime":1,"message":"m","type":"t","zzz":{extra}}}'
    values = spark.createDataFrame([(text,)], "value string")
    assert require_keys(values).count() == 1
    if "[" not in extra:  # the value of an asked key is made into text, which Spark does to a depth of 1000
        assert require_keys(values, "eventTime", "zzz").count() == 1
    assert [r.type for r in decode_changes(values, change_schema(count=1)).collect()] == ["t"]
    land_text(values, str(tmp_path / "out"))
    (back,) = text_values(spark, str(tmp_path / "out")).collect()
    assert back.value == text
    landed = json_rows(spark, str(tmp_path / "out"), change_schema(count=1))
    assert [r.type for r in landed.collect()] == ["t"]


def test_a_long_text_is_decoded(spark):
    text = '{"type":"' + "x" * 21_000_000 + '"}'
    values = spark.createDataFrame([(text,)], "value string")
    (row,) = decode_changes(values, change_schema(count=1)).collect()
    assert len(row.type) == 21_000_000
