import os

from chatloom.plans import staging


def test_own_staged_tables_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "stage_dir", lambda session: str(tmp_path))
    assert not staging.remove_staged(spark)
    assert staging.stage(spark.range(5), "five").count() == 5
    other = tmp_path / "chatloom" / "another-application" / "table"
    other.mkdir(parents=True)
    assert staging.remove_staged(spark) and not staging.remove_staged(spark)
    assert os.listdir(tmp_path / "chatloom") == ["another-application"] and other.exists()
