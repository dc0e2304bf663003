import datetime as dt

from conftest import rows_of

from tidemark.streaming.ingest import distinct_records, keep_last_table, read_table, versions, windowed_totals

S = "id string, at timestamp, v double, n int"


def put(spark, path, rows):
    spark.createDataFrame([(i, dt.datetime(2026, 1, d), v, n) for i, d, v, n in rows], S).coalesce(1).write.mode("append").json(path)


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_keep_last_over_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    for rows in ([("a", 1, 1.0, 1), ("b", 1, 2.0, 2)], [("a", 2, 9.0, 3)], [("a", 1, 5.0, 0)]):
        put(spark, src, rows)
        drain(keep_last_table(spark.readStream.schema(S).json(src), out, ck, ["id"], ordinal="n"))
    assert rows_of(read_table(spark, out, S).select("id", "v")) == [("a", 9.0), ("b", 2.0)]
    held = versions(spark, out)
    assert sorted(held.values()) == [0, 2]  # the bucket of "b" was not written again
    assert versions(spark, str(tmp_path / "none")) == {} and read_table(spark, str(tmp_path / "none"), S).count() == 0


def test_distinct_and_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    put(spark, src, [("a", 1, 1.0, 1), ("a", 2, 1.0, 2), (None, 1, 1.0, 3), ("b", 2, 4.0, 4)])
    stream = lambda: spark.readStream.schema(S).json(src)
    for name, df in (("d", distinct_records(stream(), id_column="id", event_time="at")), ("w", windowed_totals(stream(), event_time="at", entity="id", value="v"))):
        mode = "append" if name == "d" else "complete"
        drain(df.writeStream.format("memory").queryName(f"t_{name}").outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start())
    assert sorted(r.id for r in spark.table("t_d").collect()) == ["a", "b"]
    assert {(r.id, r.window_start.day): r.total for r in spark.table("t_w").collect()} == {("a", 1): 1.0, ("a", 2): 1.0, ("b", 2): 4.0, (None, 1): 1.0}
