import gzip
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frames import values
from shelfseek.sources import arrays, files, topics
from shelfseek.streaming import jobs


def gz(folder, name, text):
    path = os.path.join(folder, name)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)
    return path


def test_json_arrays(spark, tmp_path):
    folder = str(tmp_path)
    gz(folder, "a.json.gz", '[{"asin":"1","x":{"b":1}},\n 5, {"asin":"2","t":"é"}]')
    gz(folder, "empty.json.gz", "[]")
    gz(folder, "cut.json.gz", '[{"asin":"3"}, {"as')
    gz(folder, "object.json.gz", '{"asin":"4"}')
    rows = files.read_json_array(spark, folder, partitions=3)
    assert sorted(values(files.good(rows), "value")) == ['{"asin":"1","x":{"b":1}}', '{"asin":"2","t":"é"}']
    assert sorted(values(files.bad(rows), "value", "reject_reason")) == [
        ("5", "not_an_object"), ('[{"asin":"3"}, {"as', "not_a_json_array"), ('{"asin":"4"}', "not_a_json_array"),
    ]
    with pytest.raises(Exception, match="not_a"):
        files.read_json_array(spark, folder, failfast=True).collect()


def split(parts, longest=1 << 20):
    splitter, most, found = arrays.ArraySplitter(longest), 0, []
    for part in parts:
        found += splitter.feed(part)
        most = max(most, sum(map(len, splitter.held)))
    return [*found, *splitter.finish()], most


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.recursive(st.none() | st.integers() | st.text(alphabet='a"\\{}[],é\n', max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='k"}', max_size=2), x, max_size=3), max_leaves=6), max_size=5),
    st.lists(st.integers(0, 200), max_size=6),
)
def test_an_array_cut_anywhere_gives_its_elements(items, cuts):
    text = " " + json.dumps(items, ensure_ascii=False) + "\n"
    edges = [0, *sorted(min(c, len(text)) for c in cuts), len(text)]
    found, _ = split(text[a:b] for a, b in zip(edges[:-1], edges[1:]))
    assert [json.loads(x) for x, _ in found] == items and {why for _, why in found} <= {None}


def test_a_large_array_is_held_one_element_at_a_time():
    element = json.dumps({"asin": "1", "embedding": list(range(500)), "text": "}]," * 50})
    parts = (part for k in range(20_000) for part in (("[" if k == 0 else ",") + element[:700], element[700:]))
    found, most = split(parts)
    assert len(found) == 20_000 and found[7] == (element, None) and most <= 2 * len(element)
    found, most = split(["[1, {", *["x" * 100] * 1000, "}, 2]"], longest=5000)
    assert [(x[:3], why) for x, why in found] == [("1", None), ("{xx", "element_too_long"), ("2", None)] and most <= 5100


def test_elements_of_damaged_arrays(spark, tmp_path):
    folder = str(tmp_path)
    gz(folder, "a.json.gz", '[{"asin":"1","x":{"b":1}},\n 5, {bad}, {"asin":"2","t":"é}{"}]')
    gz(folder, "cut.json.gz", '[{"asin":"3"}, {"as')
    gz(folder, "object.json.gz", '{"asin":"4"}')
    gz(folder, "empty.json.gz", "[]")
    rows = arrays.read_array_elements(spark, folder)
    assert sorted(values(files.good(rows), "value")) == ['{"asin":"1","x":{"b":1}}', '{"asin":"2","t":"é}{"}', '{"asin":"3"}']
    bad = values(files.bad(rows), "value", "reject_reason")
    assert sorted(bad) == [("5", "not_an_object"), ('{"as', "array_not_closed"), ('{"asin":"4"', "not_a_json_array"), ("{bad}", "not_json")]
    out = str(tmp_path / "out")
    stream = arrays.stream_array_elements(spark, f"{folder}/*.gz", files_per_batch=1)
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(values(spark.read.parquet(out), "value")) == sorted(values(rows, "value"))


def test_files_to_topic_with_damaged_files(spark, tmp_path):
    """Records go to the topic by key; elements and files that cannot be read go to the rejects."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.mkdir(folder)
    gz(folder, "a.json.gz", '[{"asin":"1"}, {"title":"no key"}, {bad}]')
    whole = gz(folder, "b.json.gz", "[" + ",".join(json.dumps({"asin": str(i), "noise": os.urandom(20).hex()}) for i in range(2000)) + "]")
    with open(whole, "rb") as f:
        half = f.read()[: os.path.getsize(whole) // 2]
    with open(whole, "wb") as f:
        f.write(half)
    jobs.start_publishing(
        arrays.stream_array_elements(spark, folder, 1), jobs.keyed_files_writer(f"{out}/topic"), jobs.files_writer(f"{out}/bad"), f"{out}/check"
    ).awaitTermination()
    sent = spark.read.parquet(f"{out}/topic")
    assert ("1", '{"asin":"1"}') in values(sent, "key", "value") and 100 < sent.count() < 2001
    rejected = values(spark.read.parquet(f"{out}/bad"), "reject_reason")
    assert sorted(rejected) == ["array_not_closed", "no_asin", "not_json"]
    lines = str(tmp_path / "lines")
    os.mkdir(lines)
    gz(lines, "c.ndjson.gz", '{"asin":"7"}\nbad\n')
    jobs.start_publishing(
        files.stream_ndjson(spark, lines), jobs.keyed_files_writer(f"{out}/topic2"), jobs.files_writer(f"{out}/bad2"), f"{out}/check2"
    ).awaitTermination()
    assert values(spark.read.parquet(f"{out}/topic2"), "key") == ["7"]
    assert values(spark.read.parquet(f"{out}/bad2"), "value", "reject_reason") == [("bad", "not_json")]


def test_json_lines(spark, tmp_path):
    path = gz(str(tmp_path), "a.ndjson.gz", '{"asin":"1"}\n\nbad\n[2]\n{"asin":"3"}\n')
    rows = files.read_ndjson(spark, path)
    assert values(files.good(rows), "value") == ['{"asin":"1"}', '{"asin":"3"}']
    assert values(files.bad(rows), "value", "reject_reason") == [("bad", "not_json"), ("[2]", "not_an_object")]
    assert {os.path.basename(f) for f in values(rows, "source_file")} == {"a.ndjson.gz"}
    with pytest.raises(Exception, match="not_json"):
        files.read_ndjson(spark, path, failfast=True).collect()


def test_records_are_keyed_by_the_plain_asin(spark):
    df = spark.createDataFrame([("1", "t", None)], "asin string, title string, price double")
    assert values(topics.keyed_records(df), "key", "value") == [("1", '{"asin":"1","title":"t","price":null}')]
    with pytest.raises(Exception, match="without asin"):
        topics.keyed_records(spark.createDataFrame([(None, "t")], "asin string, title string")).collect()
    raw = spark.createDataFrame([('{"asin":"x","d":1}',)], "value string")
    assert values(topics.keyed_messages(raw), "key", "value") == [("x", '{"asin":"x","d":1}')]


def test_topic_options():
    assert topics.source_options("h:9", topics.RAW_TOPIC) == {
        "kafka.bootstrap.servers": "h:9", "subscribe": "products.metadata", "startingOffsets": "latest",
    }
    earliest = topics.source_options("h:9", topics.ENRICHED_TOPIC, "earliest", {"maxOffsetsPerTrigger": "5"})
    assert earliest["startingOffsets"] == "earliest" and earliest["maxOffsetsPerTrigger"] == "5"
    sink = topics.sink_options("h:9", topics.ENRICHED_TOPIC)
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"
    assert sink["topic"] == "products.embeddings"


def test_messages_have_text_and_place(spark):
    df = spark.sql(
        "SELECT cast('k' AS binary) key, cast('v' AS binary) value, 't' topic, 1 partition, 2L offset, "
        "timestamp'2024-01-01' timestamp, 0 timestampType"
    )
    found = topics.messages(df)
    assert found.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    assert values(found, "key", "value", "offset") == [("k", "v", 2)]


def test_arrays_are_more_files_and_not_larger_ones(spark, monkeypatch):
    """A file is read by one task, so with more bytes there are more of them, and what they hold stays the same."""
    from shelfseek.plans import registered

    assert [registered.array_files(n) for n in (0, 8 * registered.ARRAY_BYTES, 9 * registered.ARRAY_BYTES, 80 * registered.ARRAY_BYTES)] == [8, 8, 9, 80]
    counts = []
    for most in (registered.ARRAY_BYTES, 10_000):
        monkeypatch.setattr(registered, "ARRAY_BYTES", most)
        read = registered.read_array_elements(spark, registered.damaged_arrays(spark, "/root/testdata/sf0.001"))
        counts.append((read.count(), read.select("source_file").distinct().count()))
    assert counts[0][0] == counts[1][0] and counts[0][1] <= 8 < counts[1][1]
