"""Addressing and reading tables."""

from silverline.session import scratch_dir
from silverline.sinks.tables import target_db
from silverline.sources.bronze import SCHEMAS, Bronze, read_bronze, table_name
from silverline.sources.fixtures import derive_bronze, write_bronze


def test_table_name_folder_and_catalog():
    assert table_name("/data/bronze", "hfj_resource") == "/data/bronze/hfj_resource"
    assert table_name("s3a://lake/bronze/", "hfj_res_ver") == "s3a://lake/bronze/hfj_res_ver"
    assert table_name("bronze_db", "hfj_resource") == "bronze_db.hfj_resource"
    assert table_name("bronze_db", "hfj_resource", physical=True) == \
        "bronze_db.public_hfj_resource"


def test_target_db_routing():
    assert target_db("silver") == "silver"
    assert target_db("silver", "  gold ") == "gold"
    assert target_db("silver", "   ") == "silver"


def test_read_bronze_uses_fixed_schema(spark):
    root = scratch_dir(spark, "bronze-read")
    write_bronze(derive_bronze(spark, "/root/testdata/sf0.001"), root)
    b = Bronze.read(spark, root)
    for name, df in b.tables().items():
        assert df.schema == SCHEMAS[name]
    assert read_bronze(spark, root, "hfj_resource").count() == 4050
