from __future__ import annotations

import os
import time
from types import SimpleNamespace

from marketloom.functions.keys import ordered_ids
from marketloom.session import RUNTIME_CONF, drop_folders, drop_stored, ensure_checkpoint_dir, new_folder, passing, prepare, stored


def _session(folder=None):
    """A stand-in session that only knows its checkpoint setting and its warehouse."""
    state = {"dir": None}
    context = SimpleNamespace(
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "s3a://shared/warehouse"}
    conf = SimpleNamespace(get=lambda key, default=None: known.get(key) or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    assert ensure_checkpoint_dir(_session("s3a://shared/checkpoints")) == "s3a://shared/checkpoints"


def test_without_a_named_folder_the_warehouse_is_used():
    session = _session()
    assert ensure_checkpoint_dir(session) == ensure_checkpoint_dir(session) == "s3a://shared/warehouse/_stored"


def test_prepare_sets_runtime_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    prepare(spark)
    assert all(spark.conf.get(key) == value for key, value in RUNTIME_CONF.items())


def test_stored_rows_no_longer_depend_on_their_source(spark):
    kept = stored(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count())
    assert kept.count() == 7
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_stored_files_can_be_dropped(spark):
    kept = stored(spark.range(5))
    folder = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(folder)
    drop_stored(spark)
    assert not os.path.exists(folder)


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return [
        name for folder in manager.localDirsString() for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")
    ]


def test_shuffle_files_go_with_their_query(spark):
    prepare(spark)
    before = set(_shuffle_files(spark))
    kept = stored(spark.range(1000).selectExpr("id % 70 AS k").groupBy("k").count())
    deadline = time.time() + 20
    while set(_shuffle_files(spark)) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not set(_shuffle_files(spark)) - before
    assert kept.count() == 70


def test_a_folder_can_be_dropped_before_the_others(spark):
    folder = new_folder(spark)
    early, late = stored(spark.range(5), folder), stored(spark.range(6))
    assert early.count() == 5
    drop_folders(spark, [folder])
    assert not os.path.exists(folder.removeprefix("file:")) and late.count() == 6


def test_ordered_ids_are_dense_and_rise_with_the_values(spark):
    values = spark.range(500).selectExpr("CAST(id * 37 % 1000 AS STRING) AS v").repartition(7)
    found = {r["v"]: r["n"] for r in ordered_ids(values, "v", "n").collect()}
    assert [found[v] for v in sorted(found)] == list(range(500))


def test_what_passes_goes_and_what_was_named_before_stays(spark):
    early, kept = stored(spark.range(3)), new_folder(spark)
    with passing(spark):
        inner = stored(spark.range(9))
        folder = inner.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        result = stored(inner.where("id > 4"), kept)
    assert not os.path.exists(folder)
    assert early.count() == 3 and result.count() == 4
