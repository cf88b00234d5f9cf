"""Tool calls: JSON types, canonical form, and levels of random call graphs by brute force."""

import json
import random

from wrenchline.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string"


def call(name, arguments, number="a", after=None):
    """The text of a call; ``arguments`` is JSON as given."""
    return f'{{"tool_call":{{"id":"{number}","name":"{name}","arguments":{arguments}{"" if after is None else ",\"after\":" + json.dumps(after)}}}}}'


def test_arguments_keep_their_types_and_keys_are_in_order(spark):
    given = '{"z": 1.50, "o": {"b": [1, {"y": true, "x": null}], "a": "q\\u00e9/"}, "s": "007", "n": null, "e": 1e3, "i": 10.0, "big": 123456789012345678901234567890}'
    rows = [(1, 0, "user", call("reply", given)), (2, 0, "user", call("reply", '{"o":{"a":1,"a":2}}')), (3, 0, "user", call("reply", '"text"')), (4, 0, "user", call("reply", "null"))]
    found = {r.conv_id: r for r in chat.formatted(spark.createDataFrame(rows, ROWS), spark).collect()}
    want = '{"big":123456789012345678901234567890,"e":1000.0,"i":10,"n":null,"o":{"a":"qé/","b":[1,{"x":null,"y":true}]},"s":"007","z":1.5}'
    assert found[1].json == f'{{"arguments":{want},"conv":"1","id":"1:#a","name":"reply","turn":0,"type":"call"}}'
    for conv in (2, 3):
        assert found[conv].errors == "arguments: not readable" and json.loads(found[conv].json)["content"] == rows[conv - 1][3]
    assert found[4].errors == "role: missing; text: missing"


def test_arguments_are_checked_by_json_type(spark):
    place = chat.Field("object", True, fields={"x": chat.Field("integer", True), "unit": chat.Field("string", choices=("m", "km"))}, closed=True)
    schemas = {"go": {"to": place, "via": chat.Field("array", items=place), "fast": chat.Field("boolean|null"), "speed": chat.Field("number"), "old": ("integer", False)}}
    cases = [
        ('{"to":{"x":1,"unit":"km"},"via":[{"x":2}],"fast":null,"speed":1.5,"old":"-7"}', ""),
        ('{"to":{"x":"1"}}', "to.x: not integer"),
        ('{"to":{"x":1.5,"unit":"cm"}}', "to.unit: not among its values; to.x: not integer"),
        ('{"to":{"x":1.0,"more":1}}', "to.more: unknown"),
        ('{"to":"{}","fast":"true","speed":"2"}', "fast: not boolean|null; speed: not number; to: not object"),
        ('{"to":null}', "to: not object"),
        ('{"to":{"x":1},"via":[{"x":1},{},{"x":[]},3]}', "via[].x: missing; via[].x: not integer; via[]: not object"),
        ('{"to":{"x":1},"old":"007","speed":1e999,"further":1}', "further: unknown; old: not integer; speed: not number"),
        ("{}", "to: missing"),
    ]
    rows = [(i, 0, "assistant", call("go", given)) for i, (given, _) in enumerate(cases)] + [(100, 0, "assistant", call("fly", "{}"))]
    found = {r.conv_id: r.errors for r in chat.formatted(spark.createDataFrame(rows, ROWS), spark, schemas).collect()}
    assert found == {**{i: errors for i, (_, errors) in enumerate(cases)}, 100: "unknown tool"}


def brute_levels(needs):
    """Level of each call by repeated passes; calls in or behind a cycle get none."""
    level = {}
    while True:
        ready = {c: max((level[n] + 2 for n in ns), default=0) for c, ns in needs.items() if c not in level and all(n in level for n in ns)}
        if not ready:
            return level
        level |= ready


def test_levels_of_random_call_graphs(spark):
    rng = random.Random(21)
    rows, want = [], {}
    for conv in range(12):
        n = rng.randint(1, 14)
        needs = {}
        for i in range(n):
            pool = range(n) if conv % 3 == 0 else range(i)
            size = rng.choice([0, 1, 1, 1, 2, 3]) if conv % 4 else 1
            needs[i] = set(rng.sample(list(pool), min(size, len(pool))))
        places = list(range(n))
        rng.shuffle(places)
        for turn, i in enumerate(places):
            rows.append((conv, turn, "assistant", call("reply", "{}", i, sorted(map(str, needs[i])) + ["nowhere"])))
        level = brute_levels(needs)
        want |= {f"{conv}:#{i}": level.get(i) for i in range(n)}
    found = chat.formatted(spark.createDataFrame(rows, ROWS), spark).collect()
    assert {r.call_id: r.level for r in found} == want
    assert None in want.values() and max(v or 0 for v in want.values()) > 10
    assert {r.status for r in found if r.level is None} == {"cycle"}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    saved = []
    plain = chat.Stages.save
    monkeypatch.setattr(chat.Stages, "save", lambda self, df, name: saved.append(name) or plain(self, df, name))
    rows = [(1, i, "assistant", call("reply", "{}", i, [str(i - 1)] if i else None)) for i in range(1000)]
    found = chat.formatted(spark.createDataFrame(rows, ROWS), spark).collect()
    assert {r.turn: r.level for r in found} == {i: 2 * i for i in range(1000)}
    assert len(saved) < 50


def test_odd_tables(spark):
    long = "x" * 2_000_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", call("reply", json.dumps({"text": long, "role": "r"}))), (None, 3, "user", "{}"), (2, None, None, None), (3, 0, "user", "")]
    frame = spark.createDataFrame([(*r, "mine", "own") for r in rows], ROWS + ", call_id string, arguments string")
    found = {(r.conv_id, r.turn): r for r in chat.formatted(frame, spark).collect()}
    assert len(json.loads(found[1, 1].json)["arguments"]["text"]) == len(long) and found[1, 1].errors == ""
    assert found[None, 3].status == found[2, None].status == "message"
    assert chat.formatted(frame.limit(0), spark).count() == 0
