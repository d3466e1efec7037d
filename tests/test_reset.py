import json

import pytest

from tidemark import tools
from tidemark.sources.streams import bronze_stream, record_stream
from tidemark.specs import DIMENSIONS
from tidemark.streaming import jobs

STORES = DIMENSIONS["stores"]


@pytest.mark.parametrize("own_folder", [False, True])
def test_a_reset_dimension_is_rebuilt_from_the_log(spark, tmp_path, own_folder):
    folder, log, root = (f"file://{tmp_path}/{n}" for n in ("in", "bronze", "silver"))
    assert tools.seed(spark, folder) == 0
    jobs.start(record_stream(spark, folder), jobs.write_bronze(log), f"{tmp_path}/c", "log", None).awaitTermination()
    table, seen = jobs.dimension_tables(spark, root, STORES)
    checkpoint = f"file://{tmp_path}/c2/{STORES.name}" if own_folder else jobs.checkpoint_of(root, STORES.name)

    def build():
        jobs.start(bronze_stream(spark, f"{log}/stores"), jobs.version_dimension(STORES, table, seen), checkpoint, "dim", None).awaitTermination()
        return sorted(json.dumps(r.asDict(), default=str, sort_keys=True) for r in table.read().drop("silver_updated_at").collect())

    before = build()
    assert before and tools.reset_tables(spark, root, *([f"--checkpoints=file://{tmp_path}/c2"] if own_folder else []), STORES.name) == 0
    assert table.versions() == [] and seen.versions() == []
    assert build() == before
