"""Results that are written once and read again."""

from pyspark.sql import functions as F

from normwatch.session import literal_table, written_once


def copies(folder):
    return sorted(p.name for p in folder.glob("*/*") if p.name != "done")


def test_a_second_job_reads_the_copy_and_a_changed_input_does_not(spark, tmp_path):
    source, folder = str(tmp_path / "source"), tmp_path / "kept"
    spark.range(100).write.parquet(source)

    def job(least=10):
        rows = spark.read.parquet(source).where(F.col("id") >= least)
        return written_once(rows.select((F.col("id") * 2).alias("double")), "doubles", str(folder))

    first = job()
    assert first.count() == 90 and first.agg(F.sum("double")).first()[0] == 9810
    assert len(copies(folder)) == 1
    # A second action and a second job read what is there.
    assert sorted(map(tuple, job().collect())) == sorted(map(tuple, first.collect()))
    assert len(copies(folder)) == 1
    assert all(str(folder) in file for file in job().inputFiles())
    # Another plan, another name and another state of the files are other results.
    assert job(50).count() == 50
    assert len(copies(folder)) == 2
    spark.range(100, 120).write.mode("append").parquet(source)
    assert job().count() == 110
    assert len(copies(folder)) == 3
    assert first.count() == 90


def test_tables_of_the_program_differ_by_their_rows(spark, tmp_path):
    for n, rows in enumerate(([(1,)], [(2,)], [(1,), (2,)], [(1,)])):
        table = literal_table(spark, rows, "a bigint")
        assert sorted(r[0] for r in written_once(table, "rows", str(tmp_path)).collect()) == [r for (r,) in rows]
    assert len(copies(tmp_path)) == 3


def test_an_unfinished_copy_is_not_used(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(5).write.parquet(source)
    rows = spark.read.parquet(source)
    kept = written_once(rows, "r", str(tmp_path / "kept"))
    (done,) = (tmp_path / "kept").glob("*/done")
    done.rename(tmp_path / "elsewhere")
    assert written_once(rows, "r", str(tmp_path / "kept")).count() == kept.count() == 5
    assert len(copies(tmp_path / "kept")) == 2
