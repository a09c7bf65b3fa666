"""The shared matcher against each rule's own SQL, and whole catalogues against a plain walk."""

import json
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.test_rules import c, events, rule
from tidewatch.operators import shared
from tidewatch.operators.evaluate import evaluate_rules, hits_of
from tidewatch.operators.match import FieldColumns, match_rules, trigger_of
from tidewatch.operators.predicates import leaf, tree
from tidewatch.operators.rules import rule_class

# ------------------------------------------------ matcher

TEXTS = ["a", "B", "", "x'y", "12", "true", "2024-01-01T00:00:00Z", "é"]
NUMBERS = [0, -1, 3, 3.5, -0.0, 12, 1e300, 2**53, 2**60 + 1]


def random_leaf(rnd):
    f = rnd.choice(["t", "n", "u", "o.p", "S.v1.n"])
    op = rnd.choice(["==", "!=", ">", "<", ">=", "<=", "BETWEEN", "IN", "NOT IN", "CONTAINS", "NOT_STARTS_WITH", "IS_NULL", "IS_NOT_NULL", "len", "field", "expr"])
    if op in ("==", "!="):
        return c(f, op, rnd.choice([*TEXTS, *NUMBERS, True]))
    if op in (">", "<", ">=", "<="):
        return c(f, op, rnd.choice([*NUMBERS, "12", "-3.5", "2024-01-01T00:00:00Z"]))
    if op == "BETWEEN":
        return c(f, op, rnd.choice([[0, 12], [3, 3], [5, 1], ["1", "7.5"], [-1.5, 2**60]]))
    if op in ("IN", "NOT IN"):
        return c(f, op, rnd.choice([rnd.sample(TEXTS, 3), rnd.sample(NUMBERS, 3), ["a", 12, True]]))
    if op in ("CONTAINS", "NOT_STARTS_WITH"):
        return c(f, op, rnd.choice(["a", "1", ""]))
    if op == "len":
        return c(f, ">=", 2, function="LENGTH")
    if op == "field":
        return c(f, rnd.choice(["==", "<"]), right_field="n")
    return {"expr": "n + 2 * u", "op": ">", "value": 7} if op == "expr" else c(f, op)


def random_tree(rnd, depth=2):
    if depth == 0 or rnd.random() < 0.4:
        return {"type": "CONDITION", "expression": random_leaf(rnd)}
    return {"type": rnd.choice(["AND", "OR"]), "children": [random_tree(rnd, depth - 1) for _ in range(rnd.randrange(1, 4))]}


def random_events(spark, rnd, n):
    def payload():
        value = lambda: rnd.choice([*TEXTS, *NUMBERS, True, None, [1], str(rnd.randrange(20)), rnd.uniform(-5, 20)])
        return {k: value() for k in ("t", "n", "u") if rnd.random() < 0.9} | ({"o": {"p": value()}} if rnd.random() < 0.8 else {})

    rows = [payload() for _ in range(n)]
    return events(spark, rows[: n // 2]).unionByName(events(spark, rows[n // 2 :], source="T").withColumn("seq", F.col("seq") + n))


@pytest.mark.parametrize("few", [0, 8, 1000])
def test_shared_matcher_equals_each_rule_alone(spark, monkeypatch, few):
    monkeypatch.setattr(shared, "FEW", few)
    rnd = random.Random(11)
    e = random_events(spark, rnd, 400).cache()
    rules = []
    for i in range(150):
        groups = [[random_leaf(rnd) for _ in range(rnd.randrange(3))] for _ in range(rnd.randrange(3))]
        rules.append(rule(f"r{i}", groups, source=rnd.choice("ST"), tree=random_tree(rnd) if rnd.random() < 0.7 else None))
    got = {(r.seq, r.rule_id) for r in match_rules(e, rules).select("seq", "rule_id").collect()}
    assert len(got) == match_rules(e, rules).count()
    fields = FieldColumns(rules)
    of = lambda x: leaf(x, fields)
    tests = [F.when(F.expr(f"{trigger_of(r, of)} AND {tree(r.get('condition_tree'), of)}"), r["rule_id"]) for r in rules]
    alone = fields.extract(e).select("seq", F.explode(F.array_compact(F.array(*tests))).alias("rule_id"))
    want = {(r.seq, r.rule_id) for r in alone.collect()}
    assert got == want and len({i for _, i in want}) > 80


def test_matcher_of_no_rules(spark):
    assert match_rules(events(spark, [{"a": 1}]), []).columns[-1] == "rule_id"
    assert match_rules(events(spark, [{"a": 1}]), []).count() == 0


# ------------------------------------------------ catalogues

SECOND = 1_000_000


class Walk:
    """A catalogue walked event by event."""

    def __init__(self, rows, datasets, profile):
        self.rows, self.datasets, self.profile = rows, datasets, profile

    def value(self, row, name, key):
        head, _, rest = name.partition(".")
        if head == "prof":
            return self.profile.get((key, rest))
        value = row["payload"].get(name)
        return value if value is None else str(value)

    def leaf(self, e, row, key):
        op = e["op"]
        if op == "IN_DATASET":
            values = tuple(self.value(row, f, key) for f in e["fields"])
            return None not in values and ((e["dataset_id"], values) in self.datasets) != bool(e.get("negate"))
        if e.get("expr"):
            left = eval(re.sub(r"[a-z][\w.]*", lambda m: f"v('{m.group()}')", e["expr"]), {"v": lambda n: float(self.value(row, n, key) or "nan")})
        else:
            left = self.value(row, e["field"], key)
        if left is None:
            return False
        if isinstance(e["value"], str):
            return (left == e["value"]) == (op == "==")
        left = float(left)
        return left == left and {"==": left == e["value"], ">": left > e["value"], "<": left < e["value"]}[op]

    def waits(self, node, rule, i, key):
        """The ways in which a node can still hold: sets of first arrivals it waits for."""
        if node is None:
            return {frozenset()}
        kind = node["type"]
        if kind == "CONDITION":
            e = node["expression"]
            if e["op"] == "IS_FIRST_ARRIVAL":
                return {frozenset([json.dumps(e)])}
            return {frozenset()} if self.leaf(e, self.rows[i], key) else set()
        if kind == "SEQUENCE":
            return {frozenset()} if self.sequence(node, rule, i, key) else set()
        parts = [self.waits(n, rule, i, key) for n in node["children"]]
        if kind == "OR":
            return set().union(*parts)
        out = {frozenset()}
        for part in parts:
            out = {a | b for a in out for b in part}
        return out

    def side(self, side, rule, i):
        row = self.rows[i]
        return row["source"] == side["source"] and self.triggered(rule, i) and all(self.leaf(e, row, self.key(row)) for e in side["filter"])

    def sequence(self, node, rule, i, key):
        if not self.side(node["first"], rule, i):
            return False
        name = node["join_keys"][0]["left_field"].split(".")[1]
        mine = self.value(self.rows[i], name, key)
        if mine is None:
            return False
        t, (least, most) = self.rows[i]["t"], (node["min_time"] * SECOND, node["max_time"] * SECOND)
        answers = [
            j for j in range(len(self.rows)) if t + max(least, 1) <= self.rows[j]["t"] <= t + most
            and self.value(self.rows[j], name, key) == mine and self.side(node["second"], rule, j)
        ]
        return bool(answers) == (node["pattern"] == "FOLLOWED_BY")

    def key(self, row):
        return row["payload"].get("k")

    def triggered(self, rule, i):
        row = self.rows[i]
        return any(
            t["source"] == row["source"] and any(all(self.leaf(e, row, self.key(row)) for e in g) for g in t["conditions"] or [[]])
            for t in rule["trigger_criteria"]
        )

    def hits(self, rules):
        order = sorted(range(len(self.rows)), key=lambda i: (self.rows[i]["t"], i))
        out = set()
        for r in rules:
            last, emitted = {}, {}
            for i in order:
                if not self.triggered(r, i):
                    continue
                row, key = self.rows[i], self.key(self.rows[i])
                ways = self.waits(r.get("condition_tree"), r, i, key)
                hit = frozenset() in ways
                for first in {f for way in ways for f in way}:
                    e = json.loads(first)
                    at = (first, tuple(self.value(row, n, key) for n in e["key_fields"]))
                    ttl = int(e["ttl"][:-1]) * SECOND if "ttl" in e else 1 << 60
                    if None not in at[1] and (at not in last or row["t"] >= last[at] + ttl):
                        last[at] = row["t"]
                        hit = True
                silence = r.get("cooldown_seconds", 0) * SECOND
                if hit and not (silence and key is not None and key in emitted and row["t"] < emitted[key] + silence):
                    emitted[key] = row["t"]
                    out.add((r["rule_id"], i))
        return out


def random_state(rnd, depth=2):
    kind = rnd.random()
    if depth and kind < 0.45:
        return {"type": rnd.choice(["AND", "OR"]), "children": [random_state(rnd, depth - 1) for _ in range(2)]}
    if kind < 0.55:
        return {"type": "CONDITION", "expression": {"op": "IN_DATASET", "dataset_id": "one", "fields": ["s"], "negate": rnd.random() < 0.4}}
    if kind < 0.6:
        return {"type": "CONDITION", "expression": {"op": "IN_DATASET", "dataset_id": "two", "fields": ["s", "x"]}}
    if kind < 0.7:
        return {"type": "CONDITION", "expression": rnd.choice([c("prof.a", ">", rnd.randrange(5)), c("prof.b", "==", "u"), {"expr": "prof.a * 2 - x", "op": ">", "value": 3}])}
    if kind < 0.8:
        side = lambda: {"source": "S", "filter": [rnd.choice([c("x", ">", rnd.randrange(6)), c("s", "==", "p"), {"op": "IN_DATASET", "dataset_id": "one", "fields": ["s"]}])]}
        return {"type": "SEQUENCE", "pattern": rnd.choice(["FOLLOWED_BY", "NOT_FOLLOWED_BY"]), "min_time": rnd.randrange(3), "max_time": rnd.randrange(3, 30), "time_unit": "second",
                "join_keys": [{"left_field": "first.k", "right_field": "second.k"}], "first": side(), "second": side()}
    return {"type": "CONDITION", "expression": rnd.choice([c("x", ">", rnd.randrange(8)), c("s", "==", rnd.choice("pqr")), c("s", "!=", "p")])}


def with_first(rnd, node):
    first = {"type": "CONDITION", "expression": {"op": "IS_FIRST_ARRIVAL", "key_fields": rnd.choice([["k"], ["s", "k"]]), **({"ttl": f"{rnd.randrange(1, 40)}s"} if rnd.random() < 0.8 else {})}}
    if rnd.random() < 0.3:
        return {"type": "OR", "children": [first, node]}
    return {"type": "AND", "children": [{"type": "OR", "children": [node, first]} if rnd.random() < 0.5 else node, *([] if rnd.random() < 0.3 else [])] if rnd.random() < 0.4 else [node, first]}


def mixed(rnd, n):
    rules = []
    for i in range(n):
        node = random_state(rnd)
        if rnd.random() < 0.4:
            node = with_first(rnd, node)
        groups = rnd.choice([[], [[c("x", ">", rnd.randrange(4))]], [[{"op": "IN_DATASET", "dataset_id": "one", "fields": ["s"]}], [c("prof.a", ">", 2), c("x", ">", 1)]]])
        extra = {"cooldown_seconds": rnd.choice([0, 0, 5, 20])}
        rules.append({**rule(f"r{i}", groups, tree=node, **extra), "trigger_criteria": [{"source": "S", "key_field": "k", "conditions": groups}]})
    return rules


def tables(spark, rnd, n):
    rows = []
    for i in range(n):
        payload = {"k": rnd.choice(["u1", "u2", "u3", None]), "s": rnd.choice(["p", "q", "r", None]), "x": rnd.randrange(10)}
        rows.append({"t": rnd.randrange(200) * SECOND // 2, "source": rnd.choice(["S", "S", "S", "O"]), "payload": {k: v for k, v in payload.items() if v is not None}})
    datasets = {("one", ("p",)), ("one", ("z",)), ("two", ("q", "3")), ("two", ("p", "7")), ("two", ("q", "4"))}
    profile = {("u1", "a"): "3", ("u1", "b"): "u", ("u2", "a"): "1", ("u4", "a"): "9"}
    from tidewatch.operators.match import events_of

    raw = spark.createDataFrame([(i, r["source"], json.dumps(r["payload"]), r["t"]) for i, r in enumerate(rows)], "seq bigint, source string, payload string, t bigint")
    ds = spark.createDataFrame([(d, "v1", list(v)) for d, v in datasets], "dataset_id string, dataset_version string, tuple array<string>")
    pr = spark.createDataFrame([(k, "prof", f, v) for (k, f), v in profile.items()], "key_value string, dataset_name string, field string, value string")
    return rows, datasets, profile, events_of(raw), ds, pr


@pytest.mark.parametrize("seed", [1, 2])
def test_catalogue_equals_a_walk(spark, seed):
    rnd = random.Random(seed)
    rows, datasets, profile, e, ds, pr = tables(spark, rnd, 160)
    rules = mixed(rnd, 40)
    got = [(r.rule_id, r.seq) for r in evaluate_rules(e, rules, "t", "seq", ds, pr, {"prof"}).collect()]
    want = Walk(rows, datasets, profile).hits(rules)
    assert len(got) == len(set(got))
    assert {r: sorted(s for x, s in got if x == r) for r, _ in got} == {r: sorted(s for x, s in want if x == r) for r, _ in want}
    assert len({r for r, _ in want}) > 20


def nodes_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {kind: len(re.findall(kind, plan)) for kind in ("Scan ", "Exchange", "Join", "Window")}


def test_plans_do_not_grow_with_the_rules(spark):
    rnd = random.Random(3)
    _, _, _, e, ds, pr = tables(spark, rnd, 30)
    def stateful(n):
        every = [
            [{"type": "CONDITION", "expression": {"op": "IN_DATASET", "dataset_id": "one", "fields": ["s"]}}, {"type": "CONDITION", "expression": c("prof.a", ">", i)}]
            for i in range(n)
        ]
        return [rule(f"r{i}", [], tree={"type": "AND", "children": nodes}, cooldown_seconds=i) for i, nodes in enumerate(every)]

    few, many = (nodes_of(hits_of(e, stateful(n), "t", "seq", ds, pr, {"prof"})) for n in (3, 300))
    assert few == many
    counts = defaultdict(list)
    for n in (3, 30):
        rules = [{**rule(f"r{i}", [c("x", ">", i)] and [[c("x", ">", i % 5)]], tree={"type": "AND", "children": [
            {"type": "SEQUENCE", "pattern": "FOLLOWED_BY", "min_time": 0, "max_time": i, "time_unit": "second", "join_keys": [{"left_field": "first.k", "right_field": "second.k"}],
             "first": {"source": "S", "filter": []}, "second": {"source": "S", "filter": []}}, {"type": "CONDITION", "expression": {"op": "IS_FIRST_ARRIVAL", "key_fields": ["k"], "ttl": f"{i + 1}s"}}]})} for i in range(n)]
        for kind, found in nodes_of(hits_of(e, rules, "t", "seq", ds, pr, {"prof"})).items():
            counts[kind].append(found)
    assert all(a == b for a, b in counts.values())


def test_a_stateful_trigger_is_no_stateless_rule():
    member = {"op": "IN_DATASET", "dataset_id": "d", "fields": ["a"]}
    assert rule_class(rule("r", [[member]])) == "STATELESS" and rule_class(rule("r", [[member]]), triggers=True) == "STATEFUL"
    inside = {"type": "CONDITION", "expression": {"expr": "prof.x * 2 + y", "op": ">", "value": 1}}
    assert rule_class(rule("r", [], tree=inside), {"prof"}) == "STATEFUL" and rule_class(rule("r", [], tree=inside), {"x"}) == "STATELESS"
