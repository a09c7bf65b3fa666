import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.datasets import in_dataset, load_datasets
from tidewatch.operators.evaluate import evaluate_rule, evaluate_rules
from tidewatch.operators.match import candidates, candidates_exact, events_of, match_rules
from tidewatch.operators.rules import live_rules, parse_rules, rule_class, rule_classes, rule_conditions, upsert_rules
from tidewatch.plans import fixtures as fx
from tidewatch.sources.changes import rule_changes, schema_changes


def change(rule_id, version, op="u", enabled=True, deleted="false", **more):
    return {"rule_id": rule_id, "name": rule_id, "rule_json": json.dumps({"rule_id": rule_id}), "version": version, "enabled": enabled, "__op": op, "__deleted": deleted, **more}


def live(spark, changes, chunk_rows=3):
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(changes)], "seq bigint, payload string")
    return {r.rule_id: r.version for r in live_rules(rule_changes(df), chunk_rows=chunk_rows).collect()}


GATE = [
    ([change("r", 1), change("r", 2)], {"r": 2}),
    ([change("r", 1), change("r", 1, name="again")], {"r": 1}),
    ([change("r", 3), change("r", 1)], {"r": 3}),
    ([change("r", 5), change("r", 6, "d"), change("r", 1)], {"r": 1}),
    ([change("r", v) for v in (1, 5, 3, 7, 2)], {"r": 7}),
    ([change("r", 5), change("r", 5, "d")], {"r": 5}),
    ([change("r", 1), change("r", 2, enabled=False)], {}),
    ([change("r", 1), change("r", 2, deleted="TRUE")], {}),
    ([change("ghost", 1, "d")], {}),
    ([change("r", 4), change("r", 5, "d"), change("r", 3, "d"), change("r", 2), change("r", 1)], {"r": 2}),
    ([{"rule_id": "bare"}], {}),
]


@pytest.mark.parametrize("changes,want", GATE)
def test_version_gate(spark, changes, want):
    assert live(spark, changes) == want


def test_ten_rules_five_gone_five_new(spark):
    changes = [change(f"r{i}", 1, "c") for i in range(10)] + [change(f"r{i}", 2, "d") for i in range(5)] + [change(f"n{i}", 1, "c") for i in range(5)]
    assert len(live(spark, changes)) == 10


def test_gate_against_a_plain_walk(spark):
    import random

    rnd = random.Random(3)
    changes = [change(f"r{rnd.randrange(4)}", rnd.randrange(1, 7), rnd.choice("cud"), rnd.random() > 0.1) for _ in range(400)]
    state = {}
    for c in changes:
        current = state.get(c["rule_id"])
        if current is not None and c["version"] <= current:
            continue
        if c["__op"] == "d" or not c["enabled"]:
            state.pop(c["rule_id"], None)
        else:
            state[c["rule_id"]] = c["version"]
    assert live(spark, changes, chunk_rows=7) == state


def test_fixture_log(spark):
    rows = live_rules(fx.view(spark, "", fx.RULE_LOG))
    assert {r.rule_id: (r.version, r.cond_value) for r in rows.collect()} == {"r1": (2, "70"), "r3": (3, "view"), "r4": (1, "UNKNOWN")}


def test_upsert(spark):
    stored = spark.sql("select 'a' rule_id, 1 version, 1 seq, 'old' doc")
    incoming = spark.sql("select 'a' rule_id, 1 version, 2 seq, 'new' doc union all select 'a', 2, 3, 'other'")
    assert {(r.version, r.doc) for r in upsert_rules(stored, incoming, "seq").collect()} == {(1, "new"), (2, "other")}


def test_parse_rejects_foreign_document(spark):
    rules = spark.createDataFrame([("a", json.dumps({"rule_id": "b"}))], "rule_id string, rule_json string")
    with pytest.raises(ValueError):
        parse_rules(rules)


def test_schema_changes(spark):
    rows = [{"schema_id": "a", "schema_payload": "1"}, {"schema_id": "a", "schema_payload": "2"}, {"schema_id": "b", "schema_payload": "x"}, {"schema_id": "b", "__deleted": "true"}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "seq bigint, payload string")
    assert [(r.schema_id, r.schema_payload) for r in schema_changes(df).collect()] == [("a", "2")]


def rule(rule_id, conditions, source="S", version="v1", tree=None, **more):
    return {"rule_id": rule_id, "trigger_criteria": [{"source": source, "schema_version": version, "key_field": "msisdn", "conditions": conditions}], "condition_tree": tree, **more}


def c(field, op, value=None, **more):
    return {"field": field, "op": op, "value": value, **more}


def events(spark, payloads, source="S", version="v1"):
    rows = [(i, source, version, json.dumps(p), i * 1_000_000) for i, p in enumerate(payloads)]
    return events_of(spark.createDataFrame(rows, "seq bigint, source string, schema_version string, payload string, t bigint"))


def conditions(spark, rules):
    return rule_conditions(spark.createDataFrame([(r["rule_id"], json.dumps(r)) for r in rules], "rule_id string, rule_json string"))


def test_undecided_rules_stay_candidates(spark):
    rules = [
        rule("red", [[c("colour", "==", "red")]]), rule("heavy", [[c("weight", ">", 80)]]),
        rule("mixed", [[c("shelf", "==", 12), c("label", "CONTAINS", "glass")]]),
        rule("both", [[c("colour", "==", "red"), c("shelf", "==", 12)]]), rule("blue", [[c("colour", "==", "blue")]]),
    ]
    e = events(spark, [{"colour": "blue", "weight": 3, "shelf": 40, "label": "paper"}])
    assert {r.rule_id for r in candidates(e, conditions(spark, rules)).collect()} == {"heavy", "mixed", "blue"}
    assert {r.rule_id for r in match_rules(e, rules).collect()} == {"blue"}


def test_candidates_contain_every_hit(spark):
    import random

    rnd = random.Random(5)
    values = [50, "50", "050", 50.0, "x", "true", True, False, 1, "1", None, -0.0, 0, 2**60, 2**60 + 1, "2024-01-01T00:00:00Z", "2024-01-01T07:00:00+07:00"]
    literals = [v for v in values if v is not None]

    def condition():
        name = rnd.choice(["a", "b", "c.d", "S.a", "S.v1.b"])
        kind = rnd.randrange(6)
        if kind == 0:
            return c(name, "IN", rnd.sample(literals, 3))
        if kind == 1:
            return c(name, "==", rnd.randrange(5), function="LENGTH")
        if kind == 2:
            return c(name, "==", right_field=rnd.choice(["a", "b"]))
        if kind == 3:
            return {"expr": "a * 2", "op": "==", "value": 100}
        return c(name, "==", rnd.choice(literals))

    rules = [rule(f"r{i}", [[condition() for _ in range(rnd.randrange(1, 3))] for _ in range(rnd.randrange(0, 3))]) for i in range(60)]
    e = events(spark, [{"a": rnd.choice(values), "b": rnd.choice(values), "c": {"d": rnd.choice(values)}} for _ in range(60)])
    hits = {(r.seq, r.rule_id) for r in match_rules(e, rules).collect()}
    found = {(r.seq, r.rule_id) for r in candidates(e, conditions(spark, rules)).collect()}
    assert hits <= found and len(hits) > 200 and len(found) < 60 * 60


def test_a_large_catalogue_is_no_error(spark):
    docs = spark.range(20_001).selectExpr("concat('r', id) AS rule_id", "'{}' AS rule_json")
    assert len(parse_rules(docs)) == 20_001


def test_tuples_of_another_length_are_no_members(spark):
    sets = spark.createDataFrame([("d", "v1", ["A", "B", "C"]), ("d", "v1", ["X", "Y"])], "dataset_id string, dataset_version string, tuple array<string>")
    rows = spark.createDataFrame([("A", "B"), ("X", "Y")], "p string, q string")
    both = [F.col("p"), F.col("q")]
    assert [tuple(r) for r in in_dataset(rows, both, sets, "d").collect()] == [("X", "Y")]
    assert [tuple(r) for r in in_dataset(rows, both, sets, "d", negate=True).collect()] == [("A", "B")]


def test_fifty_rules_one_hit_each_and_versions_apart(spark):
    rules = [rule(f"r{i}", [[c("code", "==", f"C{i}")]]) for i in range(50)]
    e = events(spark, [{"code": f"C{i}"} for i in range(50)])
    got = candidates_exact(e, conditions(spark, rules)).collect()
    assert {(r.seq, r.rule_id) for r in got} == {(i, f"r{i}") for i in range(50)}
    apart = [rule("a", [[c("x", "==", "1")]], "S1", "v1"), rule("b", [[c("x", "==", "1")]], "S1", "v2"), rule("d", [[c("x", "==", "1")]], "S2", "v1")]
    e = events(spark, [{"x": "1"}], "S1", "v2")
    assert [r.rule_id for r in candidates(e, conditions(spark, apart)).collect()] == ["b"]
    assert [r.rule_id for r in match_rules(e, apart).collect()] == ["b"]


PREDICATES = [  # condition, payload, result
    (c("b", "==", True), {"b": True}, True), (c("b", "!=", True), {"b": False}, True), (c("b", "==", True), {"b": "x"}, False),
    (c("b", "==", True), {"b": 1}, False), (c("b", "!=", False), {"b": "yes"}, False), (c("b", "==", True), {"b": "True"}, True), (c("s", ">", "50"), {"s": "9"}, False), (c("s", "<", "50"), {"s": 9}, True),
    (c("x", "==", right_field="y"), {"x": "007", "y": "7"}, False), (c("x", "==", right_field="y"), {"x": "7", "y": 7}, True), (c("x", "!=", right_field="y"), {"x": 9007199254740993, "y": 9007199254740992}, True),
    (c("x", ">", right_field="y"), {"x": "12345678901234567891", "y": "12345678901234567890"}, True), (c("n", "!=", 9007199254740992), {"n": 9007199254740993}, True), (c("n", "==", 9007199254740992), {"n": 9007199254740992.5}, True),
    (c("n", "==", 12), {"n": "12"}, True), (c("n", "!=", 12), {}, False), (c("n", ">", 1), {"n": True}, False), (c("n", "<", 1), {"n": None}, False),
    (c("n", "==", 9007199254740993), {"n": 9007199254740993}, True), (c("n", "==", 9007199254740993), {"n": 9007199254740992}, False),
    (c("n", ">", 1), {"n": "NaN"}, False), (c("s", "NOT_CONTAINS", "a"), {}, False), (c("s", "NOT IN", ["a"]), {"s": "b"}, True), (c("s", "NOT IN", ["a"]), {}, False),
    (c("s", "==", "it's \\ \"q\""), {"s": "it's \\ \"q\""}, True), (c("s", "STARTS_WITH", "%"), {"s": "abc"}, False), (c("s", "IN", [True]), {"s": True}, True),
    (c("t", ">", "2024-01-01T00:00:00Z"), {"t": "2024-01-01T08:00:00+07:00"}, True), (c("t", "==", "2024-01-01T00:00:00Z"), {"t": "2024-01-01T07:00:00+07:00"}, True),
    (c("a.b", "==", 1), {"a": {"b": 1}}, True), (c("a.b", "==", 1), {"a.b": 1, "a": {"b": 2}}, True), (c("a.b", "IS_NULL"), {"a": {"b": None}}, True),
    (c("S.v1.a", "==", 1), {"a": 1}, True), (c("S.a", "==", 1), {"a": 1}, True), (c("x", ">=", right_field="y"), {"x": 10, "y": "9"}, True),
    (c("x", "==", right_field="y"), {"x": "a", "y": "a"}, True), (c("x", "<", right_field="y"), {"x": "2024-01-01T00:00:00Z", "y": "2024-01-02T00:00:00Z"}, True),
    ({"expr": "a.x * 2 + 1", "op": "==", "value": 7}, {"a": {"x": 3}}, True), ({"expr": "-(x) % 3", "op": "<", "value": 0}, {"x": 4}, True),
    ({"expr": "x / y", "op": ">", "value": 0}, {"x": 1, "y": 0}, False), ({"expr": "x", "op": "NOT IN", "value": [1, 2]}, {"x": 3}, True),
]


def test_predicates(spark):
    rules = [rule(f"p{i:02d}", [[p]]) for i, (p, _, _) in enumerate(PREDICATES)]
    got = {(r.seq, r.rule_id) for r in match_rules(events(spark, [p for _, p, _ in PREDICATES]), rules).collect()}
    assert [(f"p{i:02d}", (i, f"p{i:02d}") in got) for i in range(len(PREDICATES))] == [(f"p{i:02d}", want) for i, (_, _, want) in enumerate(PREDICATES)]


@pytest.mark.parametrize("bad", ["__import__('os')", "a ** 2", "f(x)", "a if b else c", "'x'"])
def test_expressions_are_only_arithmetic(bad):
    from tidewatch.functions.arithmetic import arithmetic

    with pytest.raises(ValueError):
        arithmetic(bad, lambda n: n)


def test_conditions_table_and_class(spark):
    doc = rule("r", [[c("a", "in", ["x", "y"]), {"fields": ["p", "q"], "op": "IN_DATASET", "dataset_id": "d"}], [c("b", ">", 1)]])
    rows = {(r.group_no, r.cond_no): r for r in conditions(spark, [doc]).collect()}
    assert rows[0, 0]["values"] == ["x", "y"] and rows[0, 0].op == "IN"
    assert rows[0, 1].fields == ["p", "q"] and rows[1, 0]["values"] == ["1"]

    leafs = {
        "CEP": {"type": "CONDITION", "expression": {"op": "IS_FIRST_ARRIVAL"}},
        "STATEFUL": {"type": "CONDITION", "expression": c("prof.x", "==", 1)},
        "STATELESS": {"type": "CONDITION", "expression": c("S.v1.x", "==", '"op":"IN_DATASET"')},
    }
    docs = [rule(kind, [], tree={"type": "OR", "children": [leaf]}) for kind, leaf in leafs.items()]
    table = spark.createDataFrame([(d["rule_id"], json.dumps(d)) for d in docs], "rule_id string, rule_json string")
    assert all(r.rule_id == r.rule_class for r in rule_classes(table, ["prof"]).collect())
    assert [rule_class(d, {"prof"}) for d in docs] == list(leafs)
    assert rule_class(rule("n", [])) == "STATELESS"


def datasets(spark):
    docs = [{"dataset_id": "d", "fields": ["a", "b"], "values": [["A", "B_C"], ["A", "B_C"], ["1", 2]]}, {"dataset_id": "one", "dataset_version": "v2", "fields": ["a"], "values": [["A"]]}]
    return load_datasets(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"))


def test_dataset_membership(spark):
    ds = datasets(spark)
    assert ds.count() == 3
    rows = spark.createDataFrame([("A", "B_C"), ("A_B", "C"), ("1", "2"), (None, "B_C")], "a string, b string")
    pair = [F.col("a"), F.col("b")]
    assert {r.a for r in in_dataset(rows, pair, ds, "d").collect()} == {"A", "1"}
    assert {r.a for r in in_dataset(rows, pair, ds, "d", negate=True).collect()} == {"A_B"}
    assert in_dataset(rows, [F.col("a")], ds, "one", "v1").count() == 0


def test_membership_in_trigger_and_under_or(spark):
    member = {"fields": ["a"], "op": "IN_DATASET", "dataset_id": "one"}
    by_trigger = rule("t", [[member, c("n", ">", 1)], [c("n", "==", 0)]])
    under_or = rule("o", [], tree={"type": "OR", "children": [{"type": "CONDITION", "expression": {**member, "negate": True}}, {"type": "CONDITION", "expression": c("n", ">", 5)}]})
    e = events(spark, [{"a": "A", "n": 2}, {"a": "Z", "n": 2}, {"a": "Z", "n": 0}, {"a": "A", "n": 9}, {"n": 2}])
    hits = lambda r: sorted(x.seq for x in evaluate_rule(e, r, "t", "seq", datasets=datasets(spark)).collect())
    assert hits(by_trigger) == [0, 2, 3]
    assert hits(under_or) == [1, 2, 3]


def test_catalogue_with_cooldown_and_sequence(spark):
    alarm = rule("alarm", [[c("kind", "==", "A")]], cooldown_seconds=3)
    seq = rule("seq", [], tree={"type": "SEQUENCE", "pattern": "FOLLOWED_BY", "min_time": 0, "max_time": 2, "time_unit": "second",
               "join_keys": [{"left_field": "first.msisdn", "right_field": "second.msisdn"}],
               "first": {"source": "S", "filter": [c("kind", "==", "A")]}, "second": {"source": "S", "filter": [c("kind", "==", "B")]}})
    kinds = ["A", "A", "A", "A", "B", "A", "B"]
    e = events(spark, [{"kind": k, "msisdn": "0981234567"} for k in kinds])
    got = sorted((r.rule_id, r.seq, r.partition_key) for r in evaluate_rules(e, [alarm, seq], "t", "seq").collect())
    key = "+84981234567"
    assert got == [("alarm", 0, key), ("alarm", 3, key), ("seq", 2, key), ("seq", 3, key), ("seq", 5, key)]


def test_two_first_arrivals_of_one_term_are_refused(spark):
    first = {"type": "CONDITION", "expression": {"op": "IS_FIRST_ARRIVAL", "key_fields": ["a"], "ttl": "1m"}}
    with pytest.raises(ValueError, match="wait for each other"):
        evaluate_rule(events(spark, [{"a": 1}]), rule("x", [], tree={"type": "AND", "children": [first, {"type": "CONDITION", "expression": {**first["expression"], "ttl": "2m"}}]}), "t", "seq")
    # Under OR each waits alone.
    other = {"type": "CONDITION", "expression": {"op": "IS_FIRST_ARRIVAL", "key_fields": ["b"]}}
    either = rule("y", [], tree={"type": "OR", "children": [first, other]})
    e = events(spark, [{"a": 1, "b": 1}, {"a": 1, "b": 2}, {"a": 1, "b": 2}, {"b": 1}, {"a": 2}])
    assert sorted(r.seq for r in evaluate_rule(e, either, "t", "seq").collect()) == [0, 1, 4]


def test_matching_is_one_pass(spark):
    plan = match_rules(events(spark, [{"code": "a", "n": 2}]), [rule("a", [[c("code", "==", "a")]]), rule("n", [[c("n", ">", 1)]], tree=None)])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_arithmetic_is_exact_for_whole_numbers(spark):
    big = 2**53
    x = lambda left, op, **more: {"expr": left, "op": op, **more}
    cases = [
        (x("n - m", "==", value=0), {"n": big + 1, "m": big}, False), (x("n - m", "==", value=0), {"n": str(big), "m": big}, True),
        (x("n - m", "BETWEEN", value=[1, 1]), {"n": big + 1, "m": big}, True), (x("n * n", "==", value=(big + 1) ** 2), {"n": big + 1}, True),
        (x("a % 2", "==", value=1.5), {"a": 3.5}, False), (x("a % 2", "==", value=1), {"a": 3}, True), (x("a % 2 * 0.5", "==", value=0.5), {"a": 3}, True),
        (x("a / 2 % 2", ">=", value=0), {"a": 4}, False), (x("a % b", "==", value=0), {"a": 4, "b": 0}, False), (x("a / b", ">", value=0), {"a": 4, "b": 0}, False),
        (x("a + b", "==", value=0.75), {"a": 0.5, "b": 0.25}, True), (x("a", "IN", value=[1, big + 1]), {"a": big + 1}, True), (x("a", "NOT IN", value=[1, big]), {"a": big + 1}, True),
        (x("-a", "<", right_expr="b - 1"), {"a": 5, "b": 1}, True), (x("a + 1", "==", right_field="b"), {"a": big, "b": big + 1}, True), (x("a + 1", ">", value=0), {"a": "x"}, False),
        (x("n * n * n", ">", value=0), {"n": 10**18}, True),
    ]
    rules = [rule(f"p{i:02d}", [[e]]) for i, (e, _, _) in enumerate(cases)]
    got = {(r.seq, r.rule_id) for r in match_rules(events(spark, [p for _, p, _ in cases]), rules).collect()}
    assert [(i, (i, f"p{i:02d}") in got) for i in range(len(cases))] == [(i, want) for i, (_, _, want) in enumerate(cases)]
