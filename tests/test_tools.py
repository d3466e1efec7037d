from tidemark import tools
from tidemark.sources.streams import record_stream
from tidemark.streaming import jobs


def test_seeded_log_passes_the_checks(spark, tmp_path):
    folder, root = f"file://{tmp_path}/in", f"file://{tmp_path}/bronze"
    assert tools.list_tables(spark, root) == [] and tools.bronze_check(spark, root) == 1
    assert tools.seed(spark, folder) == 0 and tools.scenario(spark, folder, "lifecycle") == 0
    jobs.start(record_stream(spark, folder), jobs.write_bronze(root), f"{tmp_path}/c", "seeded", None).awaitTermination()
    assert tools.list_tables(spark, root) == ["inventory", "order_items", "orders", "products", "regions", "sales_reps", "stores"]
    assert jobs.read_bronze(spark, root, "inventory").count() == 600
    assert tools.smoke_test(spark) == 0 and tools.reset_tables(spark, root) == 2
    assert tools.reset_tables(spark, root, "stores") == 0 and "stores" not in tools.list_tables(spark, root)
