import json

from opinara.operators.jsonlines import drop_json_key
from opinara.sources.tables import external_table, external_tables, line_views, read_json_lines
from opinara.sinks.batches import write_batch

GOOD = [
    '{"a": 1, "attributes": {"x": [1, {"attributes": 2}]}, "b": null}',
    '{"a": "no such key"}',
    '{}',
    '{"attributes": null}',
    '{"a": 1, "b": 2, "a": 3}',
    '{"attributes": 1, "a": {"attributes": 5}, "attributes": 2, "z": [1, 2]}',
    '{"text": "line\\u2028sep \\u000b é 😀 \\"q\\"", "attributes": 0}',
    '{"text": "raw   separator"}',
    '{"n": 4.50, "m": 1e3, "big": 12345678901234567890123, "neg": -0.5, "t": true}',
    '  {"space": 1}  ',
    '\t{"tab": 1}\r',
    '{"a": {"x": 1, "x": 2}}',
    '{"long": 123456789012345678901234567890123456789012345, "attributes": 1, "s": "NaN"}',
    '{"deep": {"n": [123456789012345678901234567890123456789012345, {"m": 1.10, "e": 1E3, "s": "a \\"b\\" {"}], "z": -0.0}, "attributes": {"n": 1.5}, "list": [0.1000, -0, [1e400]]}',
    '{"zero": -0.0, "whole": -0, "long": 0.12345678901234567890123456789012345678901234567890, "attributes": [1.0]}',
    '{"nan": NaN, "inf": 1e400, "neg": -Infinity, "d": 1.10}',
]
BAD = ['{"a": 1', '[1, 2]', '5', '"text"', 'null', '', '   ', '{a: 1}', '{"a" 1}', 'attributes',
       '{"a": 1}{"b": 2}', '{"a": 1} trailing', "{'a': 1}", '{"a": 1}]', '{"a": 1}, {"b": 2}', '{"a": 1}, "b": 2', '{"a": 01}', '{"a": 1,}',
       '{"a": 1}//x']


def test_same_values_as_the_standard_parser(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(GOOD + BAD)], "i int, value string")
    clean, rejects = drop_json_key(df, "attributes")
    found = {r["i"]: r["value"] for r in clean.collect()}
    for i, text in enumerate(GOOD):
        expected = json.loads(text)
        expected.pop("attributes", None)
        # As text, since NaN is not equal to itself.
        assert json.dumps(json.loads(found[i]), sort_keys=True) == json.dumps(expected, sort_keys=True), text
    assert set(found) == set(range(len(GOOD)))
    assert sorted(r["value"] for r in rejects.collect()) == sorted(BAD)


def test_numbers_keep_their_spelling_at_any_depth(spark):
    lines = ['{"a":{"m":-0.0,"n":[123456789012345678901234567890123456789012345,1.10]},"b":-0.0,"c":1E+3,"d":[0.10,{"x":2.50}],"e":"4.50 \\" -0.0"}',
             '{"a":[[1e400]],"b":12345678901234567890123,"c":[12345678901234567890],"d - 5":[NaN,-Infinity,"NaN"]}',
             '{"long":"5 ' + '\\"' * 3000 + '","n":[' + ",".join(["1.50", '"x 1.50"'] * 4000) + "]}"]
    cut = [line[:-1] + ',"attributes":{"k":1.0}}' for line in lines]
    clean, _ = drop_json_key(spark.createDataFrame([(t,) for t in cut], "value string"), "attributes")
    assert [r["value"] for r in clean.collect()] == lines


def test_dropping_twice_is_dropping_once(spark):
    df = spark.createDataFrame([(t,) for t in GOOD], "value string")
    once, _ = drop_json_key(df, "attributes")
    twice, rejects = drop_json_key(once, "attributes")
    # A number may be spelt anew, 1000.0 as 1000; the values stay.
    values = [sorted((json.loads(r["value"], parse_constant=str) for r in df.collect()), key=lambda v: sorted(v)) for df in (once, twice)]
    assert values[0] == values[1] and rejects.isEmpty()


def test_lines_are_cut_at_line_ends_only(spark, tmp_path):
    (tmp_path / "x.json").write_bytes("a b\r\nc\x0bd\n\nlast".encode())
    (tmp_path / "x.txt").write_text("other")
    values = [r["value"] for r in read_json_lines(spark, str(tmp_path)).collect()]
    assert values == ["a b", "c\x0bd", "", "last"]


def test_external_table_is_replaced(spark, tmp_path):
    for n, rows in (("one", ['{"k": 1}']), ("two", ['{"k": 2, "j": "x"}', '{"k": 3}'])):
        (tmp_path / f"{n}.json").write_text("\n".join(rows))
        table = external_table(spark, "t_external", str(tmp_path / f"{n}.json"))
    assert sorted(map(tuple, table.select("k", "j").collect())) == [(2, "x"), (3, None)]


def test_failed_table_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "a_review.json").write_text('{"review_id": "r", "stars": 4.0}')
    status = external_tables(spark, {"t_bad": str(tmp_path / "missing"), "t_review": str(tmp_path / "a_review.json")},
                             {"review": "review_id string, stars double"})
    rows = {r["table"]: r for r in status.collect()}
    assert not rows["t_bad"]["ok"] and rows["t_bad"]["error"]
    assert rows["t_review"]["ok"] and spark.table("t_review").first() == ("r", 4.0)


def test_line_views_skip_what_is_no_object(spark, tmp_path):
    root = str(tmp_path / "landing")
    lines = [*GOOD[:2], *BAD, None, '{"k": 1, "attributes": {}}', '{"k": "no number"}']
    df = spark.createDataFrame([("e", t) for t in lines] + [("other", '{"q": [1]}'), ("none", "x")], "entity string, value string")
    write_batch(df, root, "2024-01-01-00-00", also_by=["entity"])
    names = {f"v_{e}": e for e in ("e", "other", "none")}
    sources = {v: f"SELECT value FROM parquet.`{root}` WHERE entity = '{e}'" for v, e in names.items()}
    status = {r["table"]: r["ok"] for r in line_views(spark, sources, names, {"e": "k int"}, {"e": ["attributes"]}).collect()}
    assert status == {"v_e": True, "v_other": True, "v_none": False}
    assert sorted(r["k"] or 0 for r in spark.table("v_e").collect()) == [0, 0, 0, 1]
    assert spark.table("v_e").columns == ["k", "a", "b"]
    assert spark.table("v_other").first()["q"] == [1]


def test_lines_are_parsed_as_few_times_as_can_be(spark):
    from opinara.sources.tables import line_view

    lines = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2} x',)], "value string")
    line_view(spark, "few_objects", """SELECT value FROM VALUES ('{"a": 1, "b": "x"}'), ('{"a": 2} x') AS t(value)""", "a int, b string")
    rows = spark.table("few_objects").where("a > 0")
    assert [tuple(r) for r in rows.collect()] == [(1, "x")]
    clean, _ = drop_json_key(lines, "a")
    for df, most in ((rows.select("b"), 2), (clean, 3)):
        assert str(df._jdf.queryExecution().optimizedPlan()).count("from_json(") <= most
