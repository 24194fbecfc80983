"""A manifest folder read twice as it grows."""

from plexframe.streaming import manifests


def test_new_files_are_appended_once(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder.mkdir()
    (folder / "a.jsonl").write_text('# first\n{"path": "a.tif", "dataset": "d"}\n{"path": "b.tif"}\n\n{"path": "c.tif", "error": "x"}\n')
    manifests.append_images(manifests.image_stream(spark, str(folder)), out, checkpoint).awaitTermination()
    assert {r.path for r in spark.read.parquet(out).collect()} == {"a.tif", "b.tif"}
    (folder / "b.jsonl").write_text('{"path": "b.tif"}\n{"path": "e.tif"}\n')
    manifests.append_images(manifests.image_stream(spark, str(folder)), out, checkpoint).awaitTermination()
    assert sorted(r.path for r in spark.read.parquet(out).collect()) == ["a.tif", "b.tif", "e.tif"]
    assert manifests.counts_by_dataset(manifests.image_stream(spark, str(folder))).isStreaming
