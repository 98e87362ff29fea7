from __future__ import annotations

import pytest

from billmill.session import Sizing, sized
from billmill.workspace import new_folder, shared_folder


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=None):
        self.sparkContext, self.named = Context(master), named
        self.conf = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.named or default


def test_the_named_folder_is_used():
    session = Session("spark://host:1", "store://shared/checkpoints/")
    assert shared_folder(session) == "store://shared/checkpoints/"
    assert session.sparkContext.folder == "store://shared/checkpoints/"
    assert new_folder(session, "raw").startswith("store://shared/checkpoints/raw-")


def test_only_local_sessions_fall_back_to_a_temporary_folder():
    with pytest.raises(RuntimeError):
        shared_folder(Session("yarn"))
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.sparkContext.folder


def test_a_shuffle_of_100_tb_stays_within_reach():
    sizing = Sizing(100 << 40)
    assert sizing.tasks == 102_400
    assert sizing.shuffle_blocks < 1.1e10
    assert sizing.index_bytes < 100e9 and sizing.index_bytes // sizing.tasks < 1e6
    assert sizing.settings(200) == {
        "spark.sql.shuffle.partitions": "102400",
        "spark.sql.files.maxPartitionBytes": str(1 << 30),
    }


def test_small_inputs_and_other_shuffles_keep_the_settings(spark):
    name = "spark.sql.shuffle.partitions"
    own = spark.conf.get(name)
    with sized(spark, Sizing(0)):
        assert spark.conf.get(name) == own
    with sized(spark, Sizing(50 << 30)):
        assert spark.conf.get(name) == "50"
    assert spark.conf.get(name) == own


def test_steps_are_removed_when_nothing_reads_them(spark):
    from pathlib import Path

    from billmill.workspace import recorded_steps, remove_steps, stored, unread_steps

    with recorded_steps() as steps:
        first = stored(spark.range(5), "step")
        second = stored(first.where("id > 1"), "step")
    stored(spark.range(1), "not-recorded")
    assert len(steps) == 2 and all(Path(s).exists() for s in steps)
    assert unread_steps(second, steps) == steps[:1]
    remove_steps(spark, unread_steps(second, steps))
    assert [Path(s).exists() for s in steps] == [False, True] and second.count() == 3


def test_a_load_leaves_no_steps(spark, tmp_path):
    from pathlib import Path

    from billmill.plans.warehouse import Load, run

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Service End Date,Borough,Consumption (KWH),Current Charges\n01/26/2010,Q,10,5\n")
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir()) if shared.exists() else set()
    tables = run(spark, Load(str(tmp_path / "in"), str(tmp_path / "tables"), "steps_test"))
    assert tables["electric_staging"].count() == 1
    assert set(shared.iterdir()) == before
