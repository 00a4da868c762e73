"""Record files: shapes, broken lines, checked rewrites."""

import pytest
from pyspark.sql import types as T

from signalforge.sources import files


def test_the_documents_first_list_holds_the_records(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"meta": 1, "posts": [{"a": 1}, {"a": 2}], "items": [{"b": 9}]}\n')
    assert sorted(r["a"] for r in files.read_records(spark, str(tmp_path)).collect()) == [1, 2]
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "d.json").write_text('{"a": 5}\n{"a": 6}\n')
    assert files.read_records(spark, f"{tmp_path}/plain").count() == 2


def test_broken_lines_go_and_empty_records_stay(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{}\n{bad\n{"a": null}\n')
    got = files.read_lines(spark, str(tmp_path), T.StructType().add("a", "long")).collect()
    assert sorted(str(r["a"]) for r in got) == ["1", "None", "None"]


def test_a_rewrite_is_compared_before_it_counts(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a long, b string")
    assert files.replace_verified(rows, f"{tmp_path}/new").count() == 3
    assert files.fingerprint(rows) == files.fingerprint(rows.repartition(3))
    assert files.fingerprint(rows) != files.fingerprint(rows.distinct().union(rows.filter("a = 2")))
    monkeypatch.setattr(files, "fingerprint", lambda r, seen=[]: seen.append(1) or (len(seen), 0))
    with pytest.raises(RuntimeError):
        files.replace_verified(rows, f"{tmp_path}/other")
    with pytest.raises(Exception, match="(?i)exists"):
        files.replace_verified(rows, f"{tmp_path}/new")
