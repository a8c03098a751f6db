from glob import glob

import pytest

from matchweave.plans.queries import REGISTRY
from matchweave.session import shared_dir

ROLES = ["system", "user", "assistant"]
CHATS = [(conv, turn, ROLES[min(turn, 2 - turn % 2)], f"{conv} says {turn} " + "x" * 40 * turn) for conv in range(12) for turn in range(8)]


@pytest.fixture()
def tables(spark, tmp_path):
    """The same chats and documents as one file a table and as folders of part files."""
    frames = {
        "conversations": spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string"),
        "documents": spark.createDataFrame([(i, f"Jan{i} — Dev") for i in range(20)], "doc_id long, text string"),
    }
    (tmp_path / "files").mkdir()
    for name, frame in frames.items():
        frame.toPandas().to_parquet(tmp_path / "files" / f"{name}.parquet", index=False)
        frame.repartition(4).write.parquet(str(tmp_path / "parts" / f"{name}.parquet"))
    return tmp_path


@pytest.mark.parametrize("name", ["stream_compact", "stream_compact_gaps", "stream_ingest"])
def test_a_table_may_be_a_file_or_a_folder(spark, tables, name):
    def rows(folder):
        found = REGISTRY[name](spark, str(tables / folder))
        return sorted(map(tuple, found.drop("id").collect()))

    assert rows("parts") == rows("files") != []


def test_batches_of_the_gap_stream_are_written_by_many_tasks(spark, tables):
    before = set(glob(f"{shared_dir(spark)}/stream-gaps-*"))
    assert REGISTRY["stream_compact_gaps"](spark, str(tables / "parts")).count() == 12
    (path,) = set(glob(f"{shared_dir(spark)}/stream-gaps-*")) - before
    assert len(glob(f"{path}/chats/*.parquet")) > 2
    assert len(glob(f"{path}/states/batch=*")) == 2
