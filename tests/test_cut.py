import time
from pathlib import Path

from slatemill.plans.cut import cut, lent


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for folder in folders for p in Path(folder.toString()).rglob("shuffle_*")}


def test_written_tables_leave_no_shuffle(spark):
    before, kept = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = cut(spark.range(1000).repartition(3, "id"))
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and df.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept


def test_lent_tables_end_with_their_block(spark):
    with lent(spark.range(10)) as df:
        assert df.count() == 10
        folder = Path(df.inputFiles()[0].removeprefix("file:")).parent
    assert not folder.exists()
