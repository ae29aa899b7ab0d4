"""Commits by manifest: all or nothing, once per run."""

import pytest

from threadloom import schemas
from threadloom.sources import manifest
from threadloom.sources.manifest import publish, read_published

SCHEMA = schemas._struct(k=schemas.L)


def rows(spark, *ks):
    return spark.createDataFrame([(k,) for k in ks], SCHEMA)


def held(spark, path, version=None):
    return sorted(r.k for r in read_published(spark, path, SCHEMA, version).collect())


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    assert held(spark, path) == [] and manifest.history(spark, path) == []
    assert publish(rows(spark, 1, 2), path, replace=True) == 1
    publish(rows(spark, 3), path)
    publish(rows(spark, 3), path)
    assert held(spark, path) == [1, 2, 3, 3]
    assert publish(rows(spark, 9), path, replace=True) == 4
    assert held(spark, path) == [9]
    assert held(spark, path, 1) == [1, 2] and held(spark, path, 2) == [1, 2, 3]
    publish(rows(spark), path, replace=True)
    assert held(spark, path) == []


def test_a_repeated_run_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(rows(spark, 1), path, run_id="a")
    publish(rows(spark, 5), path, run_id="b")
    publish(rows(spark, 1, 2), path, run_id="a")
    assert held(spark, path) == [1, 2, 5]
    publish(rows(spark, 7), path, replace=True)
    publish(rows(spark, 1), path, run_id="a")
    assert held(spark, path) == [1, 7]


def test_a_job_that_dies_leaves_the_old_snapshot(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(rows(spark, 1, 2), path, replace=True)
    broken = rows(spark, 3, 4).selectExpr("if(k = 4, raise_error('lost'), k) AS k")
    with pytest.raises(Exception, match="lost"):
        publish(broken, path, replace=True)
    assert held(spark, path) == [1, 2]
    with monkeypatch.context() as m:  # between data and manifest
        m.setattr(manifest, "history", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish(rows(spark, 5), path, replace=True)
    assert held(spark, path) == [1, 2]


def test_two_writers_take_two_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(rows(spark, 1), path)
    real, late = manifest.history, []

    def stale(spark, path):
        """What the second writer saw before the first committed."""
        late.append(1)
        return real(spark, path)[:0] if len(late) == 1 else real(spark, path)

    monkeypatch.setattr(manifest, "history", stale)
    assert publish(rows(spark, 2), path) == 2
    monkeypatch.undo()
    assert held(spark, path) == [1, 2]


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(rows(spark, 1), path, replace=True)
    before = read_published(spark, path, SCHEMA)
    publish(rows(spark, 2), path, replace=True)
    assert [r.k for r in before.collect()] == [1] and held(spark, path) == [2]
