import pytest

from tidemark import tools
from tidemark.sources.keyed_table import KeyedTable


def test_smoke_test_uses_the_store(spark, tmp_path):
    root = f"file://{tmp_path}"
    assert tools.smoke_test(spark, root) == 0 and tools.smoke_test(spark) == 0
    assert not list(tmp_path.glob("_smoke*"))


@pytest.mark.parametrize(("broken", "by"), [("read", lambda self, version=None: self.spark.createDataFrame([], self.schema)), ("detail", lambda self, version=None: {}), ("history", lambda self: [])])
def test_smoke_test_fails_with_a_broken_store(spark, monkeypatch, broken, by):
    monkeypatch.setattr(KeyedTable, broken, by)
    try:
        assert tools.smoke_test(spark) == 1
    except KeyError:  # a detail without its fields stops the command, which also exits with 1
        assert broken == "detail"
