from types import SimpleNamespace

import pytest

from tidecast.session import ensure_checkpoint_dir
from tidecast.sources.fixtures import load_panel_tables

from conftest import SF_SMALL

NAMES = ("lineitem", "part", "supplier", "nation", "orders", "customer")


@pytest.mark.parametrize("master, fails", [("spark://host:7077", True), ("yarn", True), ("local-cluster[2,1,1024]", True), ("local[4]", False), ("local", False)])
def test_a_cluster_needs_a_shared_folder(master, fails):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    if fails:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(spark)
    else:
        assert ensure_checkpoint_dir(spark)


def test_rewritten_input_is_seen(spark, tmp_path):
    for name in NAMES:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    before = load_panel_tables(spark, str(tmp_path), materialize=True)
    n = before.history.count()
    assert load_panel_tables(spark, str(tmp_path), materialize=True).history.inputFiles() == before.history.inputFiles()
    some = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0")
    some.write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert 0 < load_panel_tables(spark, str(tmp_path), materialize=True).history.count() < n


def test_cut_off_reaches_the_scan(spark):
    plan = load_panel_tables(spark, SF_SMALL).history._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_shipdate" in plan
