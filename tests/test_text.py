import pytest
from pyspark.sql import functions as F

from threadloom.functions import text
from threadloom.functions.keys import shard_of, shuffle_key


def values(spark, column_of, *inputs):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("v"))).collect()]


def test_url_tail(spark):
    assert values(spark, text.url_tail, "a/b/17", "17", "a/b/", "") == ["17", "17", "", ""]


def test_safe_id_keeps_18_digits_and_rejects_text(spark):
    got = values(spark, text.safe_id, "113456789012345679", "12x", None, "")
    assert got == [113456789012345679, None, None, None]


@pytest.mark.parametrize(
    "blank", [" ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "　"]
)
def test_strip_takes_what_python_takes(spark, blank):
    word = f"{blank}a{blank}b{blank}"
    assert values(spark, text.strip, word, blank) == [word.strip(), ""]
    assert word.strip() == f"a{blank}b"


def test_strip_leaves_other_characters(spark):
    assert values(spark, text.strip, "​x​", "$x.") == ["​x​", "$x."]


def test_item_line(spark):
    got = values(
        spark, lambda v: text.item_line(F.lit(7), text.prompt_text(v)), 'say "hi"\nthere', None
    )
    assert got == ['[id: 7, text: "say \'hi\'\nthere"],\n', '[id: 7, text: "nan"],\n']


def test_fill_takes_one_slot(spark):
    assert values(spark, lambda v: text.fill("<{}>", v), "x{}") == ["<x{}>"]
    with pytest.raises(ValueError):
        text.fill("no slot", F.lit("x"))


def test_argument_label(spark):
    got = values(
        spark,
        text.argument_label,
        "argumentative",
        "non-argumentative",
        "not argumentative",
        "The response is argumentative because: it is not argumentative to ask",
        "The response is not argumentative because: nothing argumentative",
        "Non argumentative",
        "nonargumentative",
        "ERROR: HALLUCINATION",
        None,
    )
    pos, neg = "argumentative", "not_argumentative"
    assert got == [pos, neg, neg, pos, neg, neg, neg, None, None]


def test_stance_label(spark):
    got = values(
        spark,
        text.stance_label,
        "FOR",
        "FOR.",
        "The response is AGAINST because: not FOR it",
        "NEUTRAL",
        "FORWARD",
        "",
        None,
    )
    assert got == ["FOR", "FOR", "AGAINST", "NEUTRAL", None, None, None]


def test_shards_are_stable_and_cover_all(spark):
    df = spark.range(1000).select("id", shard_of(F.col("id"), 10).alias("s"))
    again = spark.range(1000).repartition(7).select("id", shard_of(F.col("id"), 10).alias("s"))
    assert sorted(df.collect()) == sorted(again.collect())
    assert {r.s for r in df.select("s").distinct().collect()} == set(range(10))


def test_shuffle_key_depends_on_seed(spark):
    row = spark.range(1).select(shuffle_key(F.col("id"), 1), shuffle_key(F.col("id"), 2)).first()
    assert row[0] != row[1]
