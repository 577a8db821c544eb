"""Design rules of the library, checked on its source."""

import pathlib
import re

SRC = pathlib.Path(__file__).resolve().parent.parent / "sentimart"


def sources():
    files = {p.relative_to(SRC).as_posix(): p.read_text() for p in SRC.rglob("*.py")}
    return {name: text for name, text in files.items() if not name.startswith("llm/")}


def uses(pattern):
    return sorted(name for name, text in sources().items() if re.search(pattern, text))


def test_no_local_checkpoint_cross_join_or_row_udf():
    assert uses(r"localCheckpoint") == []
    assert uses(r"crossJoin|how=\"cross\"") == []
    assert uses(r"@F\.udf|F\.udf\(|\budf\(") == []          # only Arrow-batched Python


def test_broadcast_only_for_the_bounded_offsets():
    # the only explicit broadcast is one row per partition (add_ordinal)
    assert uses(r"F\.broadcast\(") == ["operators/windowing.py"]


def test_driver_side_actions_are_bounded():
    collects = {name: text.count(".collect()") for name, text in sources().items() if ".collect()" in text}
    assert collects == {
        "sources/files.py": 1,       # three bad rows
        "sinks/files.py": 1,         # the columns of DESCRIBE
        "sinks/runs.py": 1,          # a row a run
        "operators/ranks.py": 1,     # a count a bucket, of at most 2 * SPLITTERS + 1
        "plans/comments.py": 2,      # paths: of new files, and of sources that a later run replaced in part
    }
    assert "limit(3).collect()" in sources()["sources/files.py"]
    assert uses(r"toPandas\(|toLocalIterator\(") == []


def test_no_rdd_api():
    assert uses(r"\.rdd\b|zipWithIndex|mapPartitions\(") == []
