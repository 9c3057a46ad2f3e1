"""Model text read in splits against reading whole files."""

import random

import pytest
from pyspark.sql import functions as F

from pktsieve.constants import LINE_BREAK
from pktsieve.sources.models import read_model_lines
from pktsieve.sources.text_lines import read_model_lines_at_volume, write_model_text


def _files(tmp_path, rnd):
    for m in range(3):
        breaks = ["\n"] * 6 + (["\r\n", "\x0b", "\f", "\x85", " "] if m else [])
        text = "".join(f"line {i} of {m} " + "x" * rnd.randrange(60) + rnd.choice(breaks) for i in range(400))
        (tmp_path / f"model{m}.txt").write_bytes(text.encode())


def _told(df):
    return sorted((r["model_id"], r["line_no"], r["line"]) for r in df.collect() if r["line"])


def test_numbers_equal_whole_files(spark, tmp_path):
    _files(tmp_path, random.Random(5))
    want = _told(read_model_lines(spark, str(tmp_path)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.minPartitionNum", "12")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        assert _told(read_model_lines_at_volume(spark, str(tmp_path))) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(want) == 1200 and "x0B" in LINE_BREAK


def test_written_folders_come_back_in_order(spark, tmp_path):
    lines = spark.range(3000).select(
        F.concat(F.lit("a b/"), (F.col("id") % 3).cast("string")).alias("model_id"), (F.col("id") * 7 - 900).alias("line_no"),
        F.concat(F.lit("l"), F.col("id").cast("string")).alias("line"),
    )
    write_model_text(lines, str(tmp_path / "out"), partitions=5)
    got = read_model_lines_at_volume(spark, str(tmp_path / "out"))
    want = []
    for m in range(3):
        want += [(f"a b/{m}", n, f"l{i}") for n, i in enumerate(range(m, 3000, 3))]
    assert _told(got) == sorted(want)


def test_two_files_of_one_name_are_an_error(spark, tmp_path):
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "m.txt").write_text("x\n")
    with pytest.raises(ValueError, match="several files"):
        read_model_lines_at_volume(spark, str(tmp_path))
