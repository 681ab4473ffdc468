"""Large delimited files cut into records by many tasks, against the reader that takes a file as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import files, records

PIECES = ["a", "b c", "", '"q"', '"x,y"', '"two\nlines"', '"in ""quotes"""', '"""\n"""', '5" wide', '"\n\n"', '",\n,"', '"a ""\n"" b"', '"end\r\nof"', "é", "x" * 40]


def text_of(rng, rows, end="\n"):
    lines = ["first,second,third"]
    lines += [",".join([str(i), rng.choice(PIECES), rng.choice(PIECES)]) for i in range(rows)]
    return end.join(lines) + end


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_rows_equal_those_of_whole_files(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    paths = [str(tmp_path / f"{k}.csv") for k in range(3)]
    for path, rows in zip(paths, (400, 150, 3)):
        with open(path, "w", newline="") as f:
            f.write(text_of(rng, rows, end))
    whole = spark.read.options(**files.CSV_OPTIONS).csv(paths)
    lines = records.numbered_lines(spark, paths)
    assert lines.select("file", "split").distinct().count() > 15
    assert len(records.files_with_breaks(spark, paths[:2])) == 2
    got = files.read_rows(spark, paths, ["first", "second", "third"])
    assert rows_of(got) == rows_of(whole)


def test_a_value_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i}, ""{i}""' for i in range(400))
    path = tmp_path / "long.csv"
    path.write_text(f'first,second\n1,"{long}"\n2,b\n3,"{long}"\n4,"c\nd"\n')
    got = {r[0]: r[1] for r in files.extract_csv(spark, str(path)).collect()}
    assert got == {"1": long.replace('""', '"'), "2": "b", "3": long.replace('""', '"'), "4": "c\nd"}


def test_files_without_breaks_are_split_by_the_reader(spark, tmp_path, small_splits):
    path = tmp_path / "plain.csv"
    path.write_text("first,second\n" + "".join(f'{i},"a, ""b"""\n' for i in range(300)))
    assert records.files_with_breaks(spark, [str(path)]) == []
    got = files.extract_csv(spark, str(path))
    assert got.rdd.getNumPartitions() > 3 and got.count() == 300
    assert {r[0] for r in got.select("second").distinct().collect()} == {'a, "b"'}


def test_wrong_header_is_named(spark, tmp_path, small_splits):
    for name, head in (("a", "first,second"), ("b", "second,first")):
        (tmp_path / f"{name}.csv").write_text(f"{head}\n" + '1,"x\ny"\n' * 200)
    with pytest.raises(ValueError, match="b.csv"):
        files.extract_csv(spark, str(tmp_path))


def test_names_that_need_escaping_and_a_broken_header(spark, tmp_path, small_splits):
    path = tmp_path / "odd.csv"
    path.write_text('"a\nb",c d\n' + '1,"x\ny"\n' * 200)
    got = files.extract_csv(spark, str(path))
    assert got.columns == ["a\nb", "c d"] and got.count() == 200
    assert got.filter(F.col("`c d`") == "x\ny").count() == 200


@pytest.mark.parametrize("size,expected", [("134217728b", 134217728), ("256m", 268435456), ("1GB", 2**30), ("700", 700)])
def test_sizes(size, expected):
    assert files.bytes_of(size) == expected
