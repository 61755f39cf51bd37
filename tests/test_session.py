"""Session settings and the shared folder."""

from types import SimpleNamespace

from quarrymill.session import REQUIRED_SETTINGS, pin, shared_dir


def fake(master, **conf):
    get = lambda key, default=None: conf.get(key.replace(".", "_"), default)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=context)


def test_the_cluster_names_the_shared_folder(spark):
    assert shared_dir(fake("spark://m:7077", spark_checkpoint_dir="s3a://bucket/tmp/")) == "s3a://bucket/tmp"
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_without_a_name_a_cluster_never_uses_a_local_folder():
    found = shared_dir(fake("yarn", spark_sql_warehouse_dir="hdfs://nn/warehouse/"))
    assert found == "hdfs://nn/warehouse/_quarrymill"


def test_without_a_name_a_local_master_keeps_one_folder():
    local = fake("local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_pin_restores_the_settings_results_depend_on(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    pin(spark)
    assert all(spark.conf.get(key) == value for key, value in REQUIRED_SETTINGS.items())
