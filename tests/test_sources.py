import json

import pytest

from tastegrid.config import DOMAINS
from tastegrid.operators import positions
from tastegrid.operators.rules import tag_map
from tastegrid.sinks import results as K
from tastegrid.sources import catalogue, json_records, logs, tables, tags


def write_parquet(path, **columns):
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table(columns), path)


def test_log_folder_with_unusable_files(spark, tmp_path):
    write_parquet(tmp_path / "a.parquet", username=["u", "v"], content_id=[5, 6],
                  duration=[1.0, None], profile_id=[1, 2], extra=["x", "y"])
    write_parquet(tmp_path / "b.parquet", username=["w"], content_id=["c"], duration=[3.5],
                  profile_id=[3])
    write_parquet(tmp_path / "c.parquet", username=["n"], content_id=["c"], profile_id=[3])
    (tmp_path / "d.parquet").write_bytes(b"this is not parquet")
    log, report = logs.read_watch_log(spark, str(tmp_path))
    rows = sorted((r.username, r.content_id, r.duration, r.profile_id) for r in log.collect())
    assert rows == [("u", "5", 1.0, 1), ("v", "6", None, 2), ("w", "c", 3.5, 3)]
    assert {r.status: r.files for r in logs.skipped_files(report).collect()} == {
        "missing duration": 1, "unreadable": 1}


def test_jobs_grow_with_bad_files_and_not_with_files(spark, tmp_path, monkeypatch):
    def some(n, missing=(), as_text=False):
        rows = {"username": ["u"] * n, "content_id": [str(i) if as_text else i for i in range(n)],
                "duration": [1.0] * n, "profile_id": list(range(n))}
        return {c: v for c, v in rows.items() if c not in missing}

    for k in range(60):
        write_parquet(tmp_path / f"{k:03}.parquet", **some(2, as_text=k >= 30))
    write_parquet(tmp_path / "007.parquet", **some(2, missing=("duration",)))
    write_parquet(tmp_path / "041.parquet", **some(2, missing=("duration", "username"), as_text=True))
    (tmp_path / "017.parquet").write_bytes(b"junk")
    write_parquet(tmp_path / "055.parquet", username=["u"], content_id=["c"], duration=[2.0],
                  profile_id=[None])  # a column of nothing but nulls is stored as another type
    asked = []
    merged = logs._merged
    monkeypatch.setattr(logs, "_merged", lambda s, p: (asked.append(len(p)), merged(s, p))[1])
    report = {r.path[-11:-8]: (r.status, r.signature) for r in
              logs.inspect_log_files(spark, str(tmp_path)).collect()}
    assert report.pop("007")[0] == "missing duration" and report.pop("017")[0] == "unreadable"
    assert report.pop("041")[0] == "missing username,duration"
    assert report.pop("055")[0] == "ok"
    assert {k: v for k, v in report.items() if v[0] != "ok"} == {}
    assert {v for k, v in report.items() if k < "030"} == {("ok", "string,bigint,double,bigint")}
    assert {v for k, v in report.items() if k >= "030"} == {("ok", "string,string,double,bigint")}
    assert len(asked) < 40 and sum(n == 1 for n in asked) < 12
    asked.clear()
    for bad in ("007", "017", "041", "055"):
        write_parquet(tmp_path / f"{bad}.parquet", **some(2, as_text=bad > "030"))
    logs.inspect_log_files(spark, str(tmp_path))
    assert asked == [60, 30, 30]


def test_a_file_with_a_damaged_page_is_left_out_whole(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    n = 40_000
    rows = pa.table({
        "username": [f"user{i * 7919 % n}" for i in range(n)],
        "content_id": [str(i * 104729 % n) for i in range(n)],
        "duration": [float(i % 97) for i in range(n)], "profile_id": list(range(n)),
    })
    pq.write_table(rows, tmp_path / "a.parquet", row_group_size=5_000, use_dictionary=False)
    pq.write_table(rows.slice(0, 100), tmp_path / "b.parquet")
    raw = bytearray((tmp_path / "a.parquet").read_bytes())
    third = len(raw) // 3
    raw[third : 2 * third] = b"\xff" * third  # page headers among them
    (tmp_path / "a.parquet").write_bytes(raw)
    log, report = logs.read_watch_log(spark, str(tmp_path))
    assert log.count() == 100
    assert {r.path[-9:]: r.status for r in report.collect()} == {
        "a.parquet": "damaged", "b.parquet": "ok"
    }


def test_an_error_of_the_store_is_no_bad_file(spark, tmp_path, monkeypatch):
    write_parquet(tmp_path / "a.parquet", username=["u"], content_id=["c"], duration=[1.0],
                  profile_id=[1])
    with pytest.raises(Exception, match="(?i)no filesystem|s3a"):
        logs.read_watch_log(spark, "s3a://bucket/log")
    assert not logs._parse_error(OSError("Connection timed out"))
    wrapped = (
        "[FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER] Encountered error while reading file "
        "s3a://b/x.parquet. Could not read footer.\nDriver stacktrace:\n\tat a.B.c(D.java:1)\n"
        "Caused by: org.apache.spark.SparkException: Could not read footer for file\n"
        "Caused by: {}\n\tat e.F.g(H.java:2)"
    )
    for cause in ("java.net.SocketTimeoutException: connect timed out", "java.io.IOException",
                  "software.amazon.awssdk.core.exception.SdkClientException: Unable to execute",
                  "org.apache.hadoop.fs.s3a.AWSClientIOException: getFileStatus on x"):
        assert not logs._parse_error(OSError(wrapped.format(cause))), cause
    for cause in ("java.lang.RuntimeException: file:/x.parquet is not a Parquet file. Expected",
                  "java.io.IOException: can not read class org.apache.parquet.format.PageHeader",
                  "java.io.EOFException: Reached the end of stream with 4 bytes left to read"):
        assert logs._parse_error(OSError(wrapped.format(cause))), cause
    monkeypatch.setattr(logs, "PARSE_ERRORS", ())  # as if the reader had said something else
    (tmp_path / "d.parquet").write_bytes(b"junk")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        logs.read_watch_log(spark, str(tmp_path))


def test_log_folder_without_usable_file(spark, tmp_path):
    (tmp_path / "d.parquet").write_bytes(b"junk")
    with pytest.raises(FileNotFoundError):
        logs.read_watch_log(spark, str(tmp_path))


def test_catalogue_scan(spark, tmp_path):
    deep = tmp_path / "x" / "y"
    deep.mkdir(parents=True)
    (tmp_path / "content_movie_20.json").write_text(json.dumps(
        [{"content_id": 1, "content_duration": 10, "tag_names": "a"}, {"content_id": "2"}]))
    (deep / "content_movie_21.json").write_text(json.dumps({"content_id": "3", "mood": "dark"}))
    (tmp_path / "content_movie_22.json").write_text("{broken")
    (tmp_path / "content_clip_20.json").write_text(json.dumps({"content_id": "4"}))
    (tmp_path / "other.json").write_text(json.dumps({"content_id": "5"}))
    good, broken = catalogue.read_catalogue(spark, str(tmp_path), DOMAINS["movie"], ("mood",))
    assert sorted((r.content_id, r.content_duration, r.mood) for r in good.collect()) == [
        ("1", "10", None), ("2", None, None), ("3", None, "dark")]
    assert broken.count() == 1 and "content_movie_22" in broken.first().source_file
    everything, _ = catalogue.read_catalogue(spark, str(tmp_path), DOMAINS["all"])
    assert sorted(r.content_id for r in everything.collect()) == ["1", "2", "3", "4"]


VALUES = ["x", "}", "{[", 'q"}', "é}", "\\", '\\"', "]", "long " * 40, "", None, 7,
          {"n": {"m": "}"}}, [{"q": 1}, "}"]]
BROKEN = [
    "[{0},{1}", "[{0},{1}]]", "[[{0}]]", "[{0}{1}]", "{0}{1}", "[{0},{1},]", "[,{0}]", "{0},", "[", "]", "}}",
    "{{", '"text"', "[1,{0}]", "[{0}]x", "[{0}],[{1}]", '[{{"a":"1}}]', "[{0},,{1}]",
]


@pytest.mark.parametrize("sent", [100_000, 0])
@pytest.mark.parametrize("cut", ["101", "900", "64m"])
def test_records_are_found_from_any_byte_range(spark, tmp_path, cut, sent):
    import random
    draw = random.Random(cut)

    def record():
        return {k: draw.choice(VALUES) for k in ("content_id", "tag_names", "other")
                if draw.random() < 0.8}

    wanted, broken = {}, set()
    for k in range(24):
        rows = [record() for _ in range(draw.choice([0, 1, 2, 25]))]
        text = json.dumps(rows, indent=draw.choice([None, 2]), ensure_ascii=k % 2 == 0)
        if k % 6 == 5:
            rows = [record()]
            text = json.dumps(rows[0], indent=draw.choice([None, 1])) + draw.choice(["", " \n"])
        wanted[f"content_movie_2{k:03}.json"] = (text if k % 7 else "\ufeff" + text, rows)
    wanted["content_movie_2e.json"] = ("", [])
    wanted["content_movie_2f.json"] = (" \n", [])
    for k, form in enumerate(BROKEN):
        name = f"content_movie_2x{k}.json"
        broken.add(name)
        wanted[name] = (form.format(*(json.dumps(record()) for _ in range(2))), [])
    for k, (name, (text, _)) in enumerate(wanted.items()):
        folder = tmp_path / f"deep{k % 3}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(text, encoding="utf8")
    before = {c: spark.conf.get(c) for c in (
        "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        good, bad = json_records.scan_records(
            spark, str(tmp_path), "content_movie_2*.json", catalogue.catalogue_schema(), sent)
        got = {}
        for r in good.orderBy("source_file", "_at").collect():
            got.setdefault(r.source_file.split("/")[-1], []).append((r.content_id, r.tag_names))
        assert {r.source_file.split("/")[-1] for r in bad.collect()} == broken
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)

    def shown(v):
        return v if v is None or isinstance(v, str) else json.dumps(
            v, separators=(",", ":"), ensure_ascii=False)

    for name, (_, rows) in wanted.items():
        assert got.get(name, []) == [
            (shown(r.get("content_id")), shown(r.get("tag_names"))) for r in rows], name


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    n = 40_000
    rows = [{"content_id": str(k), "tag_names": "}{" * (k % 9)} for k in range(n)]
    (tmp_path / "content_movie_20.json").write_text(json.dumps(rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
        good, broken = catalogue.read_catalogue(spark, str(tmp_path), DOMAINS["movie"])
        segments = json_records._segments(spark, str(tmp_path), "content_movie_20.json")
        tasks = segments.select("block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 5 and broken.count() == 0
    assert [r.content_id for r in good.orderBy("_at").collect()] == [str(k) for k in range(n)]


def test_catalogue_without_files(spark, tmp_path):
    good, broken = catalogue.read_catalogue(spark, str(tmp_path), DOMAINS["movie"])
    assert good.collect() == [] and broken.collect() == []


def test_tags_one_level_down_last_wins(spark, tmp_path):
    for name, rows in (("a", [{"TAG_ID": 1, "TAG_NAME": "red"}, {"TAG_ID": 2, "TAG_NAME": "hot"}]),
                       ("b", [{"TAG_ID": 9, "TAG_NAME": "red", "more": 1}])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "tags.json").write_text(json.dumps(rows))
    (tmp_path / "top.json").write_text(json.dumps([{"TAG_ID": 7, "TAG_NAME": "top"}]))
    read = tags.read_tags(spark, str(tmp_path))
    got = {r.tag_name: r.tag_id for r in tag_map(read, "source_order").collect()}
    assert got == {"red": 9, "hot": 2}


def test_broken_tag_file_is_an_error(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "tags.json").write_text("[{")
    with pytest.raises(Exception, match="(?i)malformed"):
        tags.read_tags(spark, str(tmp_path)).collect()


def test_build_if_absent(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build(n):
        def run():
            calls.append(n)
            return spark.range(n)
        return run

    assert tables.build_if_absent(spark, path, build(3)).count() == 3
    assert tables.build_if_absent(spark, path, build(4)).count() == 3
    assert tables.build_if_absent(spark, path, build(5), refresh=True).count() == 5
    assert calls == [3, 5]
    with pytest.raises(FileNotFoundError, match="missing thing"):
        tables.require_table(spark, str(tmp_path / "no"), "thing")


def test_log_slices_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(i,) for i in range(12)], "k int")
    K.write_log_slices(positions.with_positions(df, ["k"]), str(tmp_path / "s"))
    sizes = {r.part: r["count"] for r in spark.read.parquet(str(tmp_path / "s"))
             .groupBy("part").count().collect()}
    assert sizes == {1: 2, 2: 2, 3: 2, 4: 2, 5: 4}
