import math
import random

import pytest

from apportion.operators.formula import add_result_columns, settle
from apportion.plans.formula_text import FormulaTextError, formula_from_text, item_from_text

S = "#dataset[value(b.v), where(k)]"
P = "#dataset[value(a.p)]"


@pytest.fixture(scope="module")
def frames(spark):
    a = spark.createDataFrame([(1, 10.0, "x"), (2, 0.0, "y"), (3, 5.0, None)], "k int, p double, t string")
    b = spark.createDataFrame([(1, 2.0, "R"), (1, 4.0, "S"), (3, 7.0, "R")], "k int, v double, f string")
    return {"a": a, "b": b}


def ev(frames, text, kind="double"):
    given = {**frames, "a": add_result_columns(frames["a"], {"r": kind})}
    return [r.r for r in settle(given, [formula_from_text("f", "a", [("r", text)])])["a"].orderBy("k").select("r").collect()]


@pytest.mark.parametrize("text, expected", [
    ("1 + 2 * 3 - 4 / 8", [6.5] * 3),
    (f"return $.sum({S});", [6, 0, 7]),  # unmatched alone: no value, the old one stays
    (f"return $.sum({S}) + 1", [7, 1, 8]),  # unmatched in arithmetic: 0
    (f"return {P} / $.sum({S})", [10 / 6, math.nan, 5 / 7]),
    (f"return ({P} + 1) / ({P} * 0)", [math.inf] * 3),
    (f"return -({P} + 1) / 0", [-math.inf] * 3),
    (f"7 % {P}", [7, math.nan, 2]),
    (f"var x = $.sum({S}); if (x > 6) {{ return 1; }} else if (x == null) return 2; return 3;", [3, 2, 1]),
    (f"var x = 1; if ({P} > 6) x = x + 1; if ({P} < 6) {{ x = x * 10; x = x + 1 }} return x;", [2, 11, 11]),
    (f"$.count(#dataset[value(b.v),where(k),filter(f=R)]) || -1", [1, -1, 1]),
    ("return #dataset[value(a.t)] == 'x' ? 1 : 0", [1, 0, 0]),
    ("return #dataset[value(a.t)] != \"x\" ? 1 : 0", [0, 1, 1]),
    (f"Math.round({P} / 3 * 100) / 100", [3.33, 0, 1.67]),
    (f"Math.max(1, $.average({S}), {P})", [10, 1, 7]),
    (f"Math.min({P}, 3) + Math.abs(-1) + Math.pow(2, 3) + Math.floor(1.5) + Math.ceil(1.5) + Math.sqrt(4)", [17, 14, 17]),
    ("$.sum(#dataset[value(b.v)])", [13] * 3),  # without where: the whole data set
    ("$.sum(#dataset[ value( b.v ) , filter( f = 'R' , k = 1 ) , where( k = k ) ])", [2, 0, 0]),
    ("!(1 > 2) && 3", [3] * 3),
    ("(1 > 2 || 2 >= 2) && !(1 == 2) ? 5 : 6", [5] * 3),
    ("// a remark\n/* and\nanother */ 1.25e1", [12.5] * 3),
    ("'12' * 2", [24] * 3),
    ("true ? null : 1", [0] * 3),
    ("", [0] * 3), (None, [0] * 3), ("return;", [0] * 3), ("return '';", [0] * 3),
    (f"if ({P} > 6) return 9;", [9, 0, 0]),
])
def test_script_rules(frames, text, expected):
    got = ev(frames, text)
    assert all((math.isnan(g) and math.isnan(e)) or g == pytest.approx(e) for g, e in zip(got, expected)), got


def test_texts_join(frames):
    assert ev(frames, "'a' + #dataset[value(a.t)] + 1", "string") == ["ax1", "ay1", "anull1"]


@pytest.mark.parametrize("text, position", [
    ("1 +", 3), ("#dataset[value(b)]", 15), ("$.sum(3)", 6), ("foo", 0), ("#dataset[value(b.v), where(k]", 20), ("1 2", 2), ("return 1 +* 2;", 10),
    ("$.nope(#dataset[value(b.v),where(k)])", 7), ("if (1 {", 6), ("#dataset[where(k)]", 0), ("@", 0), ("Math.pow(1)", 0), ("#dataset[value(b.v), filter(=3)]", 28),
    ("var = 3;", 4), ("return (1;", 9), ("if (1) { return 1;", 18), ("#dataset value(b.v)", 8), ("return 1 return 2", 9), ("#dataset[value(b.v), value(b.v)]", 20),
])
def test_bad_text_raises_with_its_position(text, position):
    with pytest.raises(FormulaTextError) as wrong:
        item_from_text("r", text)
    assert wrong.value.position == position and "position" in str(wrong.value)


def test_calls_become_shared_inputs(frames):
    item = item_from_text("r", f"$.sum({S}) / $.count({S}) + $.sum({S}) - {P}")
    assert [(i.kind, i.dataset, i.field, i.on) for i in item.inputs] == [
        ("sum", "b", "v", (("k", "k"),)), ("list", "b", "v", (("k", "k"),)), ("value", "a", "p", ())]
    given = {**frames, "a": add_result_columns(frames["a"], {"r": "double"})}
    plan = settle(given, [formula_from_text("f", "a", [("r", f"$.sum({S}) / $.count({S})")])])["a"]
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_random_arithmetic_against_plain_numbers(frames):
    rng = random.Random(5)

    def make(depth):
        if depth == 0:
            return rng.choice([str(rng.randint(0, 9)), P, f"$.sum({S})", f"$.average({S})"])
        a, b = make(depth - 1), make(depth - 1)
        return rng.choice([f"({a} {rng.choice('+-*')} {b})", f"Math.max({a}, {b})", f"-{a}"])

    values = [{P: 10.0, f"$.sum({S})": 6.0, f"$.average({S})": 3.0}, {P: 0.0, f"$.sum({S})": None, f"$.average({S})": None}, {P: 5.0, f"$.sum({S})": 7.0, f"$.average({S})": 7.0}]

    def plain(text, v):
        """The same text by Python's own arithmetic, nulls as 0."""
        for call, value in v.items():
            text = text.replace(call, repr(value if value is not None else 0.0))
        return eval(text.replace("Math.max", "max"))

    for _ in range(12):
        text = make(2)
        expected = [plain(text, v) for v in values]
        assert ev(frames, f"({text}) + 0") == pytest.approx(expected), text
