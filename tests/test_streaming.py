import pytest

from groundshift.sources.tables import table
from groundshift.streaming import scenes


@pytest.mark.parametrize("files", [1, 100])
def test_arriving_scenes_give_the_batch_selection(spark, sf_dir, tmp_path, files):
    """Also where two processings of one acquisition come in different batches."""
    s = table(spark, sf_dir, "scenes").select("scene_id", "tile", "ts", "platform", "cloud").limit(300)
    again = s.withColumn("scene_id", s["scene_id"] + 1_000_000)
    s = s.union(again.where("scene_id % 2 = 0"))
    for i, part in enumerate([s.where("scene_id % 3 = 0"), s.where("scene_id % 3 <> 0"), s.limit(50)]):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = scenes.arriving(spark, str(tmp_path / "in"), s.schema, "3650 days", files)
    scenes.keep_selection(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    got = scenes.selection(spark, str(tmp_path / "out"))
    want = scenes.latest_processing(s)
    assert sorted(tuple(r) for r in got.select("tile", "scene_id").collect()) == sorted(tuple(r) for r in want.select("tile", "scene_id").collect())
