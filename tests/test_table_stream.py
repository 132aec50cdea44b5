import pytest
from tabularium.sources import shapes


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_of_one_file_or_of_parts_is_streamed_whole(spark, tmp_path, parts):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "doc_id long, text string")
    folder = tmp_path / "tables" / "documents.parquet"
    if parts > 1:
        rows.repartition(parts).write.parquet(str(folder))
    else:
        rows.coalesce(1).write.parquet(str(tmp_path / "one"))
        folder.parent.mkdir()
        next((tmp_path / "one").glob("part-*.parquet")).rename(folder)
    stream = shapes.table_stream(spark, str(folder.parent), "documents")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True)
    writer.start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 10
