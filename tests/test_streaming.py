from emberlog import LogTable
from emberlog.plans.registry import table
from emberlog.streaming.search import read_index_stream, search_stream, write_stream


def test_stream_gives_the_rows_of_the_batch_and_only_new_ones(spark, sf_dir, tmp_path):
    events = table(spark, sf_dir, "events")
    source = tmp_path / "in"
    clause = {"bool": {"must": [{"term": {"event_type": "error"}}, {"range": {"value": {"gt": 50}}}]}}

    def drain():
        stream = search_stream(read_index_stream(spark, str(source), events.schema), clause)
        shown = LogTable(stream, "ts").between("2024-01-01").select("event_id:id, value").df
        write_stream(shown, str(tmp_path / "out"), str(tmp_path / "offsets"), available_now=True).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    def batch(part):
        return sorted(r.event_id for r in part.where("event_type = 'error' AND value > 50").collect())

    first, second = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    first.write.mode("append").parquet(str(source))
    assert drain() == batch(first)
    second.write.mode("append").parquet(str(source))
    assert drain() == batch(events)
    assert drain() == batch(events)
