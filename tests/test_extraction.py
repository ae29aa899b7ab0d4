"""Golden answers of both cutting modes."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from threadloom.functions.answers import MISSING_ID as M
from threadloom.operators.annotation import RESPONSE
from threadloom.operators.extraction import attach, extract


def cut(spark, ids, output, mode, error=None):
    df = spark.createDataFrame([(0, ids, output, error)], RESPONSE)
    rows = extract(df, mode).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(len(ids)))
    return [(r.id, r.result) for r in rows]


TWO = '[\n[id: 1, annotation: "FOR"],\n[id: 2, annotation: "AGAINST"]\n]'
SUFFIX = '[id: 25, annotation: "FOR"],[id: 5, annotation: "AGAINST"]'
PREFIX = '[id: 123, annotation: "FOR"],\n[id: 99, annotation: "NEUTRAL because 12 is x"]'
BRACKET = '[id: 1, annotation: "FOR because [sic] x"]'

STRICT = [
    ([1, 2], TWO, ["FOR", "AGAINST"]),
    ([5, 25, 7], SUFFIX, ["AGAINST", "FOR", M]),
    ([12, 123, 99], PREFIX, [M, "FOR", "NEUTRAL because 12 is x"]),
    ([1], BRACKET, ["FOR because [sic] x"]),
    ([1], '[id: 1, annotation: "a\nb"]', ["a\nb"]),
    ([1, 2], "[id: 1, annotation: FOR],[ id:2 ,annotation:  AGAINST ]", ["FOR", "AGAINST"]),
    ([1], '[id: 1, annotation: "first"],[id: 1, annotation: "second"]', ["first"]),
    ([1, 1], '[id: 1, annotation: "x"]', ["x", "x"]),
    ([113456789012345679], '[id: 113456789012345679, annotation: "x"]', ["x"]),
    ([1], "", [M]),
    ([1], '[id: 99999999999999999999, annotation: "x"]', [M]),
    ([1], '[[id: 1, annotation: "FOR because: see ["x"] and more"]]', ['FOR because: see ["x"] and more']),
    (
        [1, 2],
        '[[id: 1, annotation: "FOR because: they quote "[id: 2, annotation: x]" here"], [id: 2, annotation: "AGAINST"]]',
        ['FOR because: they quote "[id: 2, annotation: x]" here', "AGAINST"],
    ),
    (
        [1, 2, 3],
        '[[id: 1, annotation: "a "[id: 2, annotation: x], [id: 3, annotation: "y"]" b"],\n[id: 2, annotation: "c"]; 3) [id: 3, annotation: d]]',
        ['a "[id: 2, annotation: x], [id: 3, annotation: "y"]" b', "c", "d"],
    ),
    ([1, 2], "[id: 1, annotation: FOR, says [id: 2, annotation: no] there], [id: 2, annotation: AGAINST [sic]]", ["FOR, says [id: 2, annotation: no] there", "AGAINST [sic]"]),
    ([1, 2], '[id: 1, annotation: "open [ bracket"],[id: 2, annotation: "shut ] bracket"]', ["open [ bracket", "shut ] bracket"]),
    ([1], '[[id: 1, annotation: "open [ bracket"]]', ["open [ bracket"]),
    ([1, 2], '[id: 1, annotation: "no quote], [id: 2, annotation: no bracket', ["no quote", M]),
    ([1, 2], '[id: 1, annotation: "A"] and then [id: 2, annotation: "B"]] Note ["x"].', ["A", "B"]),
    ([1, 2], '1. [id: 1, annotation: ""]\n2. [id: 2, annotation: "deep [[a] [b "c"]] end"]\n```', ["", 'deep [[a] [b "c"]] end']),
    ([1], '[id: 1, annotation: "é😀 [ü "ß"] 日本"]', ['é😀 [ü "ß"] 日本']),
    ([1, 2], '{"x": [{"id": 1}]} ["id": "1", "annotation": "A"], ["id": "2", "annotation": B "b"]', ["A", 'B "b']),
]


@pytest.mark.parametrize("ids, output, expected", STRICT)
def test_strict(spark, ids, output, expected):
    assert cut(spark, ids, output, "strict") == list(zip(ids, expected))


COMPAT = [
    ([1, 2], TWO, ['1, annotation: "FOR"],\n[id:', '2, annotation: "AGAINST"]\n]']),
    (
        [5, 25, 7],
        SUFFIX,
        ['5, annotation: "FOR"],[id: 5, annotation: "AGAINST"]', "2", M],
    ),
    (
        [12, 123, 99],
        PREFIX,
        ["", '123, annotation: "FOR"],\n[id:', '99, annotation: "NEUTRAL because 12 is x"]'],
    ),
    ([1], BRACKET, ['1, annotation: "FOR because [sic] x"]']),
    ([1], "", [M]),
    ([7, 8], "nothing here", [M, M]),
    ([1, 2], "é1 ü 2 ß", ["1 ü", "2 ß"]),
]


@pytest.mark.parametrize("ids, output, expected", COMPAT)
def test_compat(spark, ids, output, expected):
    assert cut(spark, ids, output, "compat") == list(zip(ids, expected))


def test_failed_batch_has_no_result_and_no_marker(spark):
    for mode in ("strict", "compat"):
        assert cut(spark, [1, 2], None, mode, "boom") == [(1, None), (2, None)]


def by_hand(ids, output):
    """Restatement of the compat rule in plain Python."""
    at = sorted((output.find(str(i)), i) for i in set(ids) if str(i) in output)
    ends = [start for start, _ in at[1:]] + [len(output)]
    found = {i: output[start:end].strip() for (start, i), end in zip(at, ends)}
    return [(i, found.get(i, M)) for i in ids]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(0, 130), min_size=1, max_size=6),
    st.text(alphabet='0123 [],":id\nxé', max_size=60),
)
def test_compat_follows_the_rule(spark, ids, output):
    assert cut(spark, ids, output, "compat") == by_hand(ids, output)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.integers(0, 10**17), st.text(alphabet="ab .,[](){}:\n0123é", max_size=30), min_size=1, max_size=8
    )
)
def test_strict_returns_what_was_answered(spark, answers):
    # Values that imitate the end of an item are ambiguous by construction.
    answers = {i: v.strip().replace("]", ")").rstrip('"') for i, v in answers.items()}
    output = "[\n" + ",\n".join(f'[id: {i}, annotation: "{v}"]' for i, v in answers.items()) + "\n]"
    assert cut(spark, list(answers), output, "strict") == list(answers.items())


def test_attach_places_by_position_and_keeps_failed(spark):
    numbered = spark.createDataFrame(
        [(0, 9, ""), (1, 9, None), (2, 8, "old")], "rn BIGINT, external_id BIGINT, r STRING"
    )
    responses = spark.createDataFrame(
        [(0, [9, 9], '[id: 9, annotation: "x"]', None), (1, [8], None, "boom")], RESPONSE
    )
    got = attach(numbered, extract(responses), 2, "r").orderBy("rn").collect()
    assert [(r.external_id, r.r) for r in got] == [(9, "x"), (9, "x"), (8, "old")]


STRICT_SHAPES = [
    '[id: 1, annotation: "FOR"],\n[id: 2, annotation: "AGAINST"]\nThese are my answers.',
    '```json\n[\n[id: 1, annotation: "FOR"],\n[id: 2, annotation: "AGAINST"]\n]\n```',
    '1. [id: 1, annotation: "FOR"]\n2. [id: 2, annotation: "AGAINST"]',
    '[id: 1, annotation: "FOR"]; [id: 2, annotation: "AGAINST"]',
    '[["id": 1, "annotation": "FOR"], ["id": "2", "annotation": "AGAINST"]]',
    "[\n[id: 1, annotation: FOR],\n[id: 2, annotation: AGAINST],\n]",
    "Sure! [id: 1, annotation: FOR] [id: 2, annotation: AGAINST]]",
]


@pytest.mark.parametrize("answer", STRICT_SHAPES)
def test_strict_finds_every_item_in_usual_shapes(spark, answer):
    df = spark.createDataFrame([(0, [1, 2], answer, None)], "batch_id long, ids array<long>, output string, error string")
    assert [r.result for r in extract(df).orderBy("pos").collect()] == ["FOR", "AGAINST"]
