"""Files as rows, the committed writer, samples of a listing, arriving files."""

from __future__ import annotations

import os
from urllib.parse import quote

import pyarrow as pa
import pytest

from mailquarry.plans import file_queries
from mailquarry.plans.registry import queries
from mailquarry.sources import eml, mailfiles
from mailquarry.streaming.features import note_arrived, read_arriving_files, write_parsed

HEAD = b"From: Ann <ann@example.com>\r\nSubject: Hi\r\n\r\n"


def table(spark, rows):
    return spark.createDataFrame(rows, "key string, content binary")


def below(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}


def test_write_and_read_back(spark, tmp_path):
    rows = [("a/b.eml", b"one"), ("a/c.eml", b""), ("d.eml", None), ("x/../y", b"q"), ("e.eml", b"first"), (None, b"no key"), ("z/", b"slash")]
    done = mailfiles.write_files(table(spark, rows).repartition(3), str(tmp_path / "out"), str(tmp_path / "st"))
    want = {"a/b.eml": b"one", "a/c.eml": b"", "d.eml": b"", "x/__/y": b"q", "e.eml": b"first", "z/_": b"slash"}
    assert below(tmp_path / "out") == want
    assert {(r.key, r.length) for r in done.collect()} == {(k, len(v)) for k, v in want.items()}
    got = {r.path.split("/out/")[1]: (bytes(r.content), r.length) for r in mailfiles.read_files(spark, str(tmp_path / "out")).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}
    mailfiles.write_files(table(spark, [("e.eml", b"again")]), "file://" + str(tmp_path / "out"), str(tmp_path / "st"))
    assert below(tmp_path / "out") == want | {"e.eml": b"again"}
    assert mailfiles.write_files(table(spark, []), str(tmp_path / "none"), str(tmp_path / "st")).count() == 0


def test_of_one_key_the_last_in_order_is_written(spark, tmp_path):
    rows = spark.createDataFrame([("k", b"a", "1"), ("k", b"c", "3"), ("k", b"b", "2")], "key string, content binary, place string").repartition(3)
    assert mailfiles.write_files(rows, str(tmp_path / "out"), str(tmp_path / "st"), order="place").count() == 1
    assert below(tmp_path / "out") == {"k": b"c"}


def test_a_killed_task_leaves_no_part_of_a_file(spark, tmp_path):
    """A task that ends amid its rows has written attempts only; a move that runs twice moves once."""
    out = tmp_path / "out"
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array(["1", "1"]), pa.array([b"x", b"yy"])], ["key", "rank", "content"])

    def dying():
        yield batch
        raise InterruptedError

    with pytest.raises(InterruptedError):
        list(mailfiles._attempted(dying(), f"{out}/_attempts/job"))
    assert below(out).keys() and all(k.startswith("_attempts/") for k in below(out))
    (named,) = mailfiles._attempted(iter([batch]), f"{out}/_attempts/job")
    moves = named.select(["key", "attempt", "length"])
    for _ in range(2):
        list(mailfiles._moved(iter([moves]), str(out)))
    assert {k: v for k, v in below(out).items() if not k.startswith("_attempts")} == {"a": b"x", "b": b"yy"}
    os.remove(out / "a")
    with pytest.raises(FileNotFoundError):
        list(mailfiles._moved(iter([moves]), str(out)))


def test_a_job_that_fails_leaves_nothing(spark, tmp_path):
    rows = table(spark, [(f"k{i}", b"x" * i) for i in range(20)]).repartition(4)
    bad = rows.selectExpr("key", "CASE WHEN key = 'k7' THEN CAST(raise_error('broken') AS BINARY) ELSE content END AS content")
    with pytest.raises(Exception, match="broken"):
        mailfiles.write_files(bad, str(tmp_path / "out"), str(tmp_path / "st"))
    assert below(tmp_path / "out") == {}
    mailfiles.write_files(rows, str(tmp_path / "out"), str(tmp_path / "st"))
    assert below(tmp_path / "out") == {f"k{i}": b"x" * i for i in range(20)}


def test_partitions_go_by_bytes():
    files = [mailfiles.File(f"/{i}", 0, n) for i, n in enumerate([10, 10, 500, 0, 0, 10, 90, 1])]
    parts = mailfiles.plan(files, 100, 1, 4)
    assert [[f.length for f in p.files] for p in parts] == [[10, 10], [500], [0, 0, 10], [90, 1]]
    assert [len(p.files) for p in mailfiles.plan([f._replace(length=0) for f in files], 1000, 1, 3)] == [3, 3, 2]
    assert mailfiles.plan([], 1, 1, 1) == []


def test_listings(spark, tmp_path):
    for name, data in {"a/x.eml": b"1", "a/b/y.eml": b"", "a/b/z.txt": b"3", "w.eml": b"22"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    names = lambda df: sorted(r.path.removeprefix(f"file://{tmp_path}/") for r in df.collect())
    assert names(mailfiles.read_files(spark, str(tmp_path))) == ["a/b/y.eml", "a/b/z.txt", "a/x.eml", "w.eml"]
    assert names(mailfiles.read_files(spark, str(tmp_path), glob="*.eml")) == ["a/b/y.eml", "a/x.eml", "w.eml"]
    assert names(mailfiles.read_files(spark, [f"file://{tmp_path}/a", str(tmp_path / "a/x.eml"), str(tmp_path / "w.eml")])) == ["a/b/y.eml", "a/b/z.txt", "a/x.eml", "w.eml"]
    assert mailfiles.read_files(spark, str(tmp_path), partition_bytes=1).rdd.getNumPartitions() == 4
    listed = mailfiles.read_files(spark, str(tmp_path), content=False)
    assert {(r.length, r.content) for r in listed.collect()} == {(1, None), (0, None), (2, None)} and listed.count() == 4
    os.makedirs(tmp_path / "empty")
    assert mailfiles.read_files(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        mailfiles.read_files(spark, str(tmp_path / "nowhere")).count()


def test_sample_opens_its_files_only(spark, tmp_path):
    mailfiles.write_files(table(spark, [(f"{i % 3}/m{i:03}.eml", HEAD + str(i).encode()) for i in range(60)]), str(tmp_path / "m"), str(tmp_path / "st"))
    count = spark.sparkContext.accumulator(0)
    got = eml.ingest_sample(spark, str(tmp_path / "m"), 9, 4, str(tmp_path / "s"), opened_files=count).collect()
    assert count.value == len(got) == 9
    order = sorted(f"{i % 3}/m{i:03}.eml" for i in range(60))
    at = [k for k, name in enumerate(order) if name.split("/")[1] in {r.og_fname for r in got}]
    assert at == list(range(at[0], at[0] + 9))


def test_arriving_files_are_read_once(spark, tmp_path):
    """Stopped, restarted and restarted without news: every file once, as in a batch."""
    run = lambda: write_parsed(read_arriving_files(spark, str(tmp_path / "m"), "*.eml", files_per_trigger=7), str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    for part in range(2):
        rows = [(f"{i % 2}/m{i}.eml", HEAD + str(i).encode()) for i in range(30 * part, 30 * part + 30)]
        mailfiles.write_files(table(spark, [*rows, (f"note{part}.txt", b"no mail")]), str(tmp_path / "m"), str(tmp_path / "st"))
        run()
    run()
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("og_fname", "body", "raw_headers").collect()]
    batch = [tuple(r) for r in eml.ingest(spark, str(tmp_path / "m"), "*.eml").select("og_fname", "body", "raw_headers").collect()]
    assert len(got) == 60 and sorted(got) == sorted(batch)


def test_stream_of_a_large_folder_names_lists_not_mails(spark, sf_dir, tmp_path, monkeypatch):
    """What the driver keeps of a stream, and reads again at each start, are the lists of mails and never their names."""
    monkeypatch.setattr(file_queries.scratch, "folder", lambda spark, name: str(tmp_path / name))
    rows = queries()["eml_stream"](spark, sf_dir)
    log = [x for p in (tmp_path / "arriving/progress/sources/0").iterdir() if not p.name.startswith(".") for x in p.read_text().splitlines()[1:]]
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count() == 200
    assert 0 < len(log) <= 4 * spark.sparkContext.defaultParallelism + 1 and not any(".eml" in x for x in log)


def test_arriving_files_noted_in_lists(spark, tmp_path):
    """Names of any characters and old files too, each once; hidden, empty and other files not, nor what lies in a hidden folder. A file that gets its bytes later is read then."""
    names = ["a b.eml", "c#d.eml", "e%20f.eml", "g?h.eml", "\u00fc/\u65e5 1/i.eml", "deep/er/k=1/j.eml", "deep/er/j.eml"]
    left = {"_x.eml": HEAD, ".y.eml": HEAD, "_attempts/z.eml": HEAD, ".h/z.eml": HEAD, "later.eml": b"", "n.txt": b"no mail"}

    def put(found):
        for name, data in found.items():
            (tmp_path / "m" / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / "m" / name).write_bytes(data)

    def run():
        mails = read_arriving_files(spark, str(tmp_path / "m"), "*.eml", label="spam", staging=str(tmp_path / "s"))
        write_parsed(mails, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
        return sorted(r.body for r in spark.read.parquet(str(tmp_path / "out")).collect())

    with pytest.raises(FileNotFoundError):
        read_arriving_files(spark, str(tmp_path / "m"), staging=str(tmp_path / "s"))
    (tmp_path / "m").mkdir()
    assert run() == []
    put({name: HEAD + quote(name).encode() for name in names} | left)
    assert run() == sorted(map(quote, names)) == run()
    put({"later.eml": HEAD + b"later", "old.eml": HEAD + b"old"})
    os.utime(tmp_path / "m/old.eml", (1, 1))
    assert run() == sorted([*map(quote, names), "later", "old"]) == run()
    ids = [r.email_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert {r.email_id for r in eml.ingest(spark, str(tmp_path / "m"), "*.eml").collect()} >= set(ids) and len(set(ids)) == 9


def test_a_trigger_takes_lists_of_so_many_files(spark, tmp_path):
    mailfiles.write_files(table(spark, [(f"{i % 2}/m{i}.eml", HEAD + str(i).encode()) for i in range(40)]), str(tmp_path / "m"), str(tmp_path / "st"))
    sizes = []
    mails = read_arriving_files(spark, str(tmp_path / "m"), files_per_trigger=9, staging=str(tmp_path / "s"))
    mails.writeStream.foreachBatch(lambda df, k: sizes.append(df.count())).option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
    assert sum(sizes) == 40 and max(sizes) <= 9


def test_a_stream_that_goes_on_takes_what_is_noted_later(spark, tmp_path):
    """What a call that failed amid its lists has not noted, the next one notes."""

    def put(numbers):
        for i in numbers:
            (tmp_path / f"m/{i}.eml").write_bytes(HEAD + str(i).encode())

    (tmp_path / "m").mkdir()
    put(range(5))
    lists = note_arrived(spark, str(tmp_path / "m"), str(tmp_path / "s"), files_per_list=2)
    full = [p for p in (tmp_path / "s/arrived").glob("part-*") if spark.read.parquet(str(p)).count()]
    assert len(full) > 2 and spark.read.parquet(lists).count() == 5
    os.remove(full[0])
    query = write_parsed(read_arriving_files(spark, str(tmp_path / "m"), staging=str(tmp_path / "s")), str(tmp_path / "out"), str(tmp_path / "progress"), once=False)
    try:
        query.processAllAvailable()
        put(range(10))
        note_arrived(spark, str(tmp_path / "m"), str(tmp_path / "s"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.og_fname for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"{i}.eml" for i in range(10)]


def test_a_header_that_mails_share_is_read_once(monkeypatch):
    """Questions about a header, and mails that share it, meet its parser once; results are those of the library's own policy."""
    from email import policy

    part = b"\r\n--zz\r\nContent-Type: text/plain; charset=utf-8\r\n\r\ntext %d\r\n--zz\r\nContent-Type: image/png; name=\"a:b.png\"\r\nContent-Disposition: inline\r\nContent-Transfer-Encoding: base64\r\n\r\ncG5n\r\n--zz--\r\n"
    raws = [HEAD[:-2] + b"Content-Type: multipart/mixed;\x0b boundary=zz\r\n" + part % k for k in range(20)] + [HEAD + b"\xff", b"Content-Type: \xff/;;=\r\n\r\nx", b""]
    calls, factory = [], policy.SMTP.header_factory
    counted = policy.SMTP.clone(header_factory=lambda name, value: calls.append(name) or factory(name, value))
    monkeypatch.setattr(policy, "SMTP", counted)
    eml._header.cache_clear()
    ours = [eml._parsed("/m/x.eml", raw, False) for raw in raws]
    assert 0 < len(calls) < 30
    monkeypatch.setattr(eml, "SMTP", policy.EmailPolicy(linesep="\r\n"))
    assert ours == [eml._parsed("/m/x.eml", raw, False) for raw in raws]


def test_a_batch_is_taken_in_parts():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * mailfiles.AT_ONCE + 1))], ["n"])
    parts = list(mailfiles.slices(batch))
    assert max(p.num_rows for p in parts) == mailfiles.AT_ONCE and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
