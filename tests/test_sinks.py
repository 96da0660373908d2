import datetime
import glob
import json
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldsieve.__main__ import main
from fieldsieve.functions import keywords as kw
from fieldsieve.operators import classify, filters
from fieldsieve.operators import tokens as tk
from fieldsieve.plans import crawl as plans
from fieldsieve.plans import tokens as token_plans
from fieldsieve.sinks import tables as tb
from fieldsieve.sinks.token_shards import LISTING, ShardReader, item_runs, read_token_shards, write_token_shards
from fieldsieve.sources import crawl as dumps
from fieldsieve.streaming import jobs

CRAWL = "text string, url string, token_count long, language string"


@pytest.fixture
def root(spark, tmp_path):
    """Three dumps; every third page of each has a keyword."""
    for d in ("CC-1", "CC-2", "CC-3"):
        rows = [(f"{d} text {i}", f"http://x/{'sport' if i % 3 == 0 else 'z'}/{i}", i, "en") for i in range(30)]
        spark.createDataFrame(rows, CRAWL).repartition(3).write.parquet(f"{tmp_path}/data/{d}")
    return str(tmp_path)


def test_reading_dumps(spark, root, tmp_path):
    every = dumps.read_dumps(spark, root)
    assert {r["dump"]: r["count"] for r in every.groupBy("dump").count().collect()} == {d: 30 for d in ("CC-1", "CC-2", "CC-3")}
    some = dumps.read_dumps(spark, root, ["CC-2"])
    assert some.count() == 30 and len(some.inputFiles()) == 3
    (tmp_path / "p.json").write_text(json.dumps({"patterns": ["CC-3", "CC-1", "CC-1", "CC-9"]}, indent=1))
    patterns = dumps.read_patterns(spark, str(tmp_path / "p.json"))
    assert dumps.pattern_names(patterns) == ["CC-1", "CC-3", "CC-9"]
    assert {r["dump"] for r in dumps.select_dumps(every, patterns).select("dump").distinct().collect()} == {"CC-1", "CC-3"}


def test_rewriting_one_dump_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(i, f"d{i % 3}") for i in range(30)], "n long, dump string")
    tb.write_dumps(df, path)
    tb.write_dumps(df.where("dump = 'd1' AND n < 5"), path)
    counts = {r["dump"]: r["count"] for r in spark.read.parquet(path).groupBy("dump").count().collect()}
    assert counts == {"d0": 10, "d1": 2, "d2": 10}
    assert tb._bytes("64MB") == 64 << 20 and tb._bytes("67108864b") == 64 << 20


def test_hot_dump_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 7)).alias("dump"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tb.write_dumps(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(glob.glob(f"{path}/dump=hot/*.parquet")) > 3
    assert spark.read.parquet(path).count() == 200_000


def test_manifest_and_reruns(spark, tmp_path):
    source, out, manifest = (str(tmp_path / n) for n in ("source", "kept", "manifest"))
    rows = [(f"http://x/{'sport' if i % 3 == 0 else 'z'}/{i}", i, f"CC-{d}") for d in (1, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "url string, token_count long, dump string")
    tb.write_dumps(df, source)
    schema = df.drop("dump").schema

    def run(step, output=out, names=manifest):
        tb.process_pending(spark, source, schema, step, output, names)

    def failing(df):
        lost = F.when(F.col("token_count") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("url"))
        return df.withColumn("url", lost)

    with pytest.raises(Exception, match="lost"):
        run(failing)
    assert tb.read_manifest(spark, manifest).count() == 0
    keep = lambda df: filters.keep_matching(df)
    run(keep)
    first = tb.read_manifest(spark, manifest).collect()
    assert {(r["name"], r["rows"]) for r in first} == {("CC-1", 10), ("CC-2", 10)}
    tb.write_dumps(df.where("dump = 'CC-1'").withColumn("dump", F.lit("CC-3")), source)
    seen = []

    def only_pending(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        read = df.select(F.col("_metadata.file_path").alias("f")).distinct().collect()
        seen.append((plan, sorted({r["f"].split("dump=")[1].split("/")[0] for r in read})))
        return keep(df)

    run(only_pending)
    run(only_pending)
    assert len(seen) == 1 and seen[0][1] == ["CC-3"]
    assert "PartitionFilters: [" in seen[0][0] and "PartitionFilters: []" not in seen[0][0]
    assert spark.read.parquet(out).count() == 30
    assert tb.read_manifest(spark, manifest).count() == 3


def test_a_dump_that_keeps_nothing_loses_its_old_rows(spark, tmp_path):
    source, out, manifest = (str(tmp_path / n) for n in ("source", "kept", "manifest"))
    df = spark.createDataFrame([(i, f"d{i % 2}") for i in range(20)], "n long, dump string")
    tb.write_dumps(df, source)
    tb.write_dumps(df, out)
    none = lambda df: df.where("n < 0")
    tb.process_pending(spark, source, df.drop("dump").schema, none, out, manifest)
    assert {(r["name"], r["rows"]) for r in tb.read_manifest(spark, manifest).collect()} == {("d0", 0), ("d1", 0)}
    assert spark.read.schema("n long, dump string").parquet(out).count() == 0


def test_named_dumps_in_both_layouts(spark, root, tmp_path):
    written = str(tmp_path / "written")
    plans.filter_crawl(spark, root, f"{written}/data")
    for base, rows in ((root, 30), (written, 10)):
        found = dumps.read_dumps(spark, base, ["CC-2"])
        assert found.count() == rows and {r["dump"] for r in found.select("dump").collect()} == {"CC-2"}
    with pytest.raises(FileNotFoundError, match="CC-9"):
        dumps.read_dumps(spark, root, ["CC-2", "CC-9"])


def test_filter_then_classify(spark, root, tmp_path):
    main(["filter", root, str(tmp_path / "f"), "-n", "CC-1"])
    assert spark.read.parquet(str(tmp_path / "f")).count() == 10
    plans.filter_crawl(spark, root, str(tmp_path / "filtered"))
    known = [("CC-1 text", 1), ("CC-2 text", 0), ("CC-3 text", 0)] * 10
    train = spark.createDataFrame(known, "text string, label int")
    model = classify.text_pipeline(features=1 << 10).fit(train)
    scorer = plans.model_scorer(model)
    plans.clean_crawl(spark, str(tmp_path / "filtered"), str(tmp_path / "clean"), str(tmp_path / "m"), scorer)
    clean = spark.read.parquet(str(tmp_path / "clean"))
    assert clean.columns == ["text", "url", "token_count", "dump"]
    assert {r["dump"]: r["count"] for r in clean.groupBy("dump").count().collect()} == {"CC-1": 10}
    done = {r["name"]: r["rows"] for r in tb.read_manifest(spark, str(tmp_path / "m")).collect()}
    assert done == {"CC-1": 10, "CC-2": 0, "CC-3": 0}


def test_compaction(spark, root, tmp_path):
    source = spark.read.parquet(f"{root}/data/CC-1", f"{root}/data/CC-2")
    out = str(tmp_path / "merged")
    tb.compact_files(source, kw.contains_any(F.col("url"), ["sport"]), 4, out)
    merged = spark.read.parquet(out)
    assert merged.count() == 20
    assert len(glob.glob(f"{out}/file_group=*")) == 2
    assert len(source.inputFiles()) == 6


def test_group_names(spark):
    files = spark.createDataFrame([(f"d/CC-{i // 5}/00{i}.parquet",) for i in range(7)], "path string")
    groups = tb.file_groups(files, 3)
    names = {r["grp"]: (r["n_files"], r["name"]) for r in tb.group_names(groups).collect()}
    assert names == {0: (3, "000_002"), 1: (3, "003_005"), 2: (1, "006_006")}
    by_folder = {r["grp"]: r["name"] for r in tb.group_names(groups, by_folder=True).collect()}
    assert by_folder == {0: "CC-0_to_CC-0", 1: "CC-0_to_CC-1", 2: "CC-1_to_CC-1"}


def test_jsonl_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "text string, url string")
    tb.export_jsonl(df, str(tmp_path / "j"))
    (line,) = [r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert json.loads(line) == {"text": "a", "url": None}


def parse_pair(path, name):
    """The documents of one pair of files, read by the format's description."""
    raw = open(f"{path}/{name}.idx", "rb").read()
    assert raw[:9] == b"MMIDIDX\x00\x00" and struct.unpack_from("<QB", raw, 9) == (1, 8)
    n, borders = struct.unpack_from("<QQ", raw, 18)
    sizes = np.frombuffer(raw, "<i4", n, 34)
    pointers = np.frombuffer(raw, "<i8", n, 34 + 4 * n)
    doc_idx = np.frombuffer(raw, "<i8", borders, 34 + 12 * n)
    assert list(doc_idx) == list(range(n + 1)) and len(raw) == 34 + 12 * n + 8 * borders
    data = open(f"{path}/{name}.bin", "rb").read()
    return [list(np.frombuffer(data, "<u2", s, p)) for s, p in zip(sizes, pointers, strict=True)]


def test_token_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [(i, list(range(i % 5)) + [65535 - i, 0]) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<int>").repartition(6)
    write_token_shards(df, path, "doc_id", F.col("tokens"), shards=3)
    listing = json.load(open(f"{path}/{LISTING}"))
    assert sum(s["n_docs"] for s in listing) == 100 and len(listing) == 3
    assert [d for s in listing for d in parse_pair(path, s["name"])] == [t for _, t in rows]
    back = read_token_shards(spark, path, tokens_per_read=50)
    assert back.rdd.getNumPartitions() > 3
    assert [r["tokens"] for r in back.orderBy("item").collect()] == [t for _, t in rows]
    write_token_shards(df.where("doc_id < 3"), path, "doc_id", F.col("tokens"), shards=2)
    assert read_token_shards(spark, path).count() == 3
    with pytest.raises(Exception, match="does not fit"):
        write_token_shards(df, str(tmp_path / "bad"), "doc_id", F.transform("tokens", lambda t: t + 1), shards=1)
    assert not os.path.exists(str(tmp_path / "bad" / LISTING))


def test_only_ranges_of_chosen_items_are_opened(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [(i, [i % 7] * (i % 9 + 1)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<int>")
    write_token_shards(df, path, "doc_id", F.col("tokens"), shards=4)

    def opened(items):
        ranges = ShardReader(path, 20, item_runs(items)).partitions()
        return [i for r in ranges for i in range(r.items_before + r.first, r.items_before + r.last)]

    assert item_runs([5, 3, 4, 4, 9]) == [(3, 6), (9, 10)] and item_runs(range(3, 6)) == [(3, 6)]
    assert len(ShardReader(path, 20).partitions()) > 8
    assert opened([42]) == [42] and opened(range(10, 13)) == [10, 11, 12]
    assert opened([99, 3, 4, 500]) == [3, 4, 99] and opened([]) == [] and opened(range(100, 200)) == []
    one = read_token_shards(spark, path, tokens_per_read=20, items=[42])
    assert one.rdd.getNumPartitions() == 1 and one.first()["tokens"] == rows[42][1]
    found = read_token_shards(spark, path, items=[5, 50, 51]).orderBy("item").collect()
    assert [(r["item"], r["tokens"]) for r in found] == [rows[5], rows[50], rows[51]]
    spans = read_token_shards(spark, path, tokens_per_read=20, offset=2, length=3).orderBy("item").collect()
    assert [r["tokens"] for r in spans] == [t[2:5] for _, t in rows]


def test_documents_of_several_items(spark, tmp_path):
    path = str(tmp_path / "shards")
    docs = [(i, [[i, j] * (j + 1) for j in range(i % 6)]) for i in range(40)]  # some hold no item
    df = spark.createDataFrame(docs, "doc_id long, items array<array<int>>")
    write_token_shards(df.where("doc_id < 25"), path, "doc_id", F.col("items"), shards=3)
    write_token_shards(df.where("doc_id >= 25"), path, "doc_id", F.col("items"), shards=2, append=True)
    expected = [(i, t) for i, items in docs for t in items]
    for per_read in (3, 1 << 20):
        rows = read_token_shards(spark, path, tokens_per_read=per_read).orderBy("item").collect()
        assert [r["item"] for r in rows] == list(range(len(expected)))
        assert [(r["document"], r["tokens"]) for r in rows] == expected


def test_epochs_as_shards(spark, tmp_path):
    (tmp_path / "docs.jsonl").write_text('{"text":"aa"}\n\n{"text":"bb"}\n{"text":"aa"}\n{"text":"dd"}\n')
    main(["tokens", str(tmp_path / "docs.jsonl"), str(tmp_path / "tok"), "3"])
    items = [r["tokens"] for r in read_token_shards(spark, str(tmp_path / "tok")).orderBy("item").collect()]
    assert len(items) == 12 and all(t[-1] == 0 for t in items)
    texts = ["aa", "aa", "bb", "dd"]
    vocabulary = {i: b for b, i in tk.byte_vocabulary().items()}
    for epoch in range(3):
        decoded = [b"".join(vocabulary[t] for t in ids[:-1]).decode() for ids in items[4 * epoch : 4 * epoch + 4]]
        assert sorted(decoded) == texts
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    assert token_plans.ordered_epochs(docs, "k", 2).count() == 8


def test_stream_reads_each_file_once(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = "url string, n long"
    first = spark.createDataFrame([("sport", 1), ("x", 2)], schema)
    first.write.parquet(source)
    types = first.schema
    for _ in range(2):
        jobs.curate_new_files(spark, source, types, out, log)
    assert spark.read.parquet(out).count() == 1
    spark.createDataFrame([("golf", 3)], schema).write.mode("append").parquet(source)
    jobs.curate_new_files(spark, source, types, out, log)
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == [1, 3]


def test_merged_files_survive_a_break_between_rows_and_names(spark, tmp_path, monkeypatch):
    source, out, names, log = (str(tmp_path / n) for n in ("in", "out", "names", "log"))
    rows = [(f"http://x/{'sport' if i % 3 else 'z'}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "url string, n long")
    df.repartition(5, "n").write.parquet(source)
    call = lambda: jobs.merge_new_files(
        spark, source, df.schema, F.col("url").contains("sport"), out, names, log, files_per_group=2
    )
    name_files, calls = jobs._name_files, []

    def breaks_on_the_second(files, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        name_files(files, path)

    monkeypatch.setattr(jobs, "_name_files", breaks_on_the_second)
    with pytest.raises(Exception, match="lost driver"):
        call()
    assert len(set(r["batch"] for r in tb.read_manifest(spark, names).collect())) == 1
    call()
    call()
    merged = spark.read.parquet(out).collect()
    assert sorted(r["n"] for r in merged) == [i for i in range(60) if i % 3]
    assert len({r["file_group"] for r in merged}) == 3
    files = tb.read_manifest(spark, names).collect()
    assert len(files) == len({r["name"] for r in files}) == 5 and sum(r["rows"] for r in files) == 40


def test_closed_windows_leave_the_state(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("loss", T.DoubleType())])

    def arrive(*steps):
        days = [(datetime.datetime(2024, 1, day, 6), loss) for day, loss in steps]
        spark.createDataFrame(days, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = jobs.closed_windows(spark.readStream.schema(schema).parquet(source), delay="1 day")
        jobs.run_appending(stream, out, log)
        rows = spark.read.schema("window_start timestamp, n_steps long, mean_loss double").parquet(out).collect()
        return sorted((r["window_start"].day, r["n_steps"], r["mean_loss"]) for r in rows)

    arrive((1, 1.0), (1, 3.0), (2, None), (2, 5.0), (5, 7.0))
    assert run() == [(1, 2, 2.0), (2, 1, 5.0)]
    arrive((1, 9.0), (4, 1.0), (5, 9.0))
    assert run() == [(1, 2, 2.0), (2, 1, 5.0)]
    assert run() == [(1, 2, 2.0), (2, 1, 5.0)]
    jobs.close_log(spark, source, schema)
    whole = [(1, 2, 2.0), (2, 1, 5.0), (4, 1, 1.0), (5, 2, 8.0)]
    assert run() == whole
    jobs.close_log(spark, source, schema)
    assert run() == whole
    late = jobs.late_rows(spark.read.schema(schema).parquet(source), spark.read.parquet(out)).collect()
    assert {r["window_start"].day: r["n_late"] for r in late} == {1: 1, 2: 0, 4: 0, 5: 0}


def test_a_table_version_counts_once_it_is_named(spark, tmp_path, monkeypatch):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = "ts timestamp, loss double"

    def run(loss):
        row = [(datetime.datetime(2024, 1, 1), loss)]
        spark.createDataFrame(row, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.run_to_table(jobs.windowed_metrics(stream), out, log)

    run(1.0)
    run(2.0)
    assert jobs.current_table(spark, out).first()["n_steps"] == 2

    def lost(*_, **__):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(jobs, "commit_manifest", lost)
        with pytest.raises(Exception, match="lost driver"):
            run(3.0)
    assert jobs.current_table(spark, out).first()["n_steps"] == 2
    run(4.0)
    assert jobs.current_table(spark, out).first()["n_steps"] == 4


def test_commands_for_grading_compaction_and_streams(spark, tmp_path):
    lines = [{"prompt": f"the sport {i}", "response": f"sport {i}"} for i in range(4)]
    for name in "ab":
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in lines))
    path = lambda name: str(tmp_path / name)
    main(["grade", path("scores"), path("rejects"), path("a.jsonl"), path("b.jsonl")])
    assert spark.read.parquet(path("scores")).count() == 8
    rows = [(f"http://x/{'sport' if i % 3 == 0 else 'z'}/{i}", i) for i in range(30)]
    spark.createDataFrame(rows, "url string, n long").repartition(6).write.parquet(path("small"))
    main(["compact", path("small"), path("merged"), "--files-per-group", "3"])
    assert spark.read.parquet(path("merged")).count() == 10
    for _ in range(2):
        main(["stream", path("small"), path("kept"), path("log")])
    assert spark.read.parquet(path("kept")).count() == 10
