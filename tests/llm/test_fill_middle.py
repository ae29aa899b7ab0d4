"""Fill-in-middle against a plain restatement, and the containers by themselves."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm.fill_middle import CHUNK, Boundaries, Container, fill_in_middle, fill_in_middle_digests, restore


def brute(doc_id, text, rate=100, suffix_first=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize(
    ("kind", "low"),
    [
        ("array", [0, 5, 7, 65535]),
        ("run", list(range(100, 9000)) + list(range(20000, 20100))),
        ("run", list(range(CHUNK))),
        ("bitmap", list(range(0, CHUNK, 2))),
        ("bitmap", list(range(1, CHUNK, 3)) + [65534, 65535]),
    ],
)
def test_container_selects_like_a_list(kind, low):
    low = np.unique(np.array(low))
    found = Container.of(low)
    assert found.kind == kind
    places = {0, 1, len(low) // 2, len(low) - 2, len(low) - 1} | set(range(0, len(low), 997))
    assert [found.select(k) for k in sorted(places)] == [int(low[k]) for k in sorted(places)]


def test_boundaries_over_many_containers():
    rng = np.random.default_rng(1)
    parts = [b"\n" * 70_000, b"a" * 200_000, bytes(rng.choice([10, 97], 150_000)), b"tail"]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.append(np.flatnonzero(data == 10) + 1, len(data))
    lines = Boundaries(data)
    assert {c.kind for c in lines.containers} == {"run", "bitmap", "array"}
    assert len(lines) == len(ends) and lines.cut(0) == 0
    for k in (1, 2, 69_999, 70_000, 70_001, 90_000, len(ends) - 1, len(ends)):
        assert lines.cut(k) == ends[k - 1]
    assert len(Boundaries(data[:0])) == 0


TEXTS = [
    None, "", "\n", "one line", "a\nb\nc", "é\nñ…\n😀 end\n\n", "\r\n a\r\nb", "x <P> y\nz", "<S>\n", "k<M>",
    "near <P <S <M\n> marks\n<", "\n" * 70_000, "line of text\n" * 30_000 + "no end", "\x00\n\x0b\x85 \n",
]


def test_hard_texts(spark):
    rows = [(10 * k + j, text, "x", j) for k, text in enumerate(TEXTS) for j in range(6)]
    rows += [(3, "a\nb\nc", "y", 0)] * 2 + [(None, "p\nq\nr", "z", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n long")
    for rate, share in ((100, 50), (60, 0), (100, 100), (0, 50)):
        cut = fill_in_middle(df, rate=rate, suffix_first=share)
        assert cut.columns == [*df.columns, "fim"]
        got = cut.select("doc_id", "text", "fim.*", restore(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
        for r in got:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text, rate, share)
            assert r.back == (r.text or "")
        assert len(got) == len(rows)


def test_digests_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a\nb", "kept")], "doc_id long, text string, fim string")
    row = fill_in_middle_digests(df).first()
    n, form, p, m, output = brute(1, "a\nb")
    assert tuple(row) == (
        1, n, form, p, m, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(b"a\nb").hexdigest()
    )
    assert fill_in_middle_digests(df.limit(0)).collect() == []
