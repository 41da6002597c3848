"""Files, the cursor-paged source against a local stub server, and the streaming forms."""

import csv
import gzip
import io
import json
import threading
from datetime import UTC, datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from citelake.operators.delivery import DeliveryStore
from citelake.session import scratch_path
from citelake.functions import text
from citelake.sources import cursor_pages, delimited, zip_pages
from citelake.streaming import incremental

ODD = [("a", None), ('say "hi"', "x\ty"), ("line\nfeed", ""), (" padded ", "a,b"), ("", "é")]


@pytest.mark.parametrize("name, crlf", [("t.csv", False), ("t.tsv", False), ("t.tsv.gz", False), ("t.csv", True), ("t.tsv.gz", True)])
def test_delimited_round_trip(spark, tmp_path, name, crlf):
    path = str(tmp_path / "deep" / name)
    df = spark.createDataFrame(ODD, "x string, y string").coalesce(1)
    delimited.write_delimited(df, path, crlf=crlf)
    raw = (gzip.open if path.endswith(".gz") else open)(path, "rb").read().decode()
    buffer = io.StringIO()
    out = csv.writer(buffer, delimiter=delimited.separator(name), lineterminator="\r\n" if crlf else "\n")
    out.writerows([("x", "y"), *[["" if v is None else v for v in r] for r in ODD]])
    assert raw.count("\r") == (len(ODD) + 1 if crlf else 0)
    assert list(csv.reader(io.StringIO(raw, newline=""), delimiter=delimited.separator(name))) == list(csv.reader(io.StringIO(buffer.getvalue(), newline=""), delimiter=delimited.separator(name)))
    back = delimited.read_delimited(spark, path, multi_line=True)
    assert [tuple(r) for r in back.collect()] == [(a or None, b or None) for a, b in ODD]
    assert not [p for p in (tmp_path / "deep").iterdir() if p.name != name and not p.name.startswith(".")]


def test_declared_types_and_no_header(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("1\tx\n2\ty\n")
    df = delimited.read_delimited(spark, str(tmp_path / "t.tsv"), header=False, types={"0": "int"}, partitions=3)
    assert df.dtypes == [("0", "int"), ("1", "string")] and df.count() == 2
    named = delimited.read_delimited(spark, str(tmp_path / "t.tsv"), header=False, columns=["a", "b"])
    assert named.columns == ["a", "b"]


def test_corrupt_lines_are_put_aside(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ("{broken",)], "value string")
    good, bad = delimited.split_corrupt(lines, "a int")
    assert [tuple(r) for r in good.collect()] == [(1,)] and [r["value"] for r in bad.collect()] == ["{broken"]


def test_fan_out(spark):
    assert delimited.fan_out(spark.range(5), lambda d: d.count(), lambda d: d.where("id > 3").count()) == [5, 1]


def test_typed_export(spark, tmp_path):
    df = spark.createDataFrame([("d", "2019-01-02T03:04:05Z", 1, "[]")], "doi string, created string, has_references int, debug string")
    delimited.write_typed(df, str(tmp_path / "w"))
    assert dict(spark.read.parquet(str(tmp_path / "w")).dtypes) == {"doi": "string", "created": "timestamp", "has_references": "boolean", "references": "string"}


@pytest.fixture()
def server():
    """Five pages and a last empty one; every second request fails first, one body is cut short."""
    state = {"requests": 0, "cut": False}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            state["requests"] += 1
            query = parse_qs(urlparse(self.path).query)
            cursor = query["cursor"][0]
            n = 0 if cursor == "*" else int(cursor)
            if state["requests"] % 2 == 0:
                self.send_error(503)
                return
            items = [{"DOI": f"10.1/{n}-{i}"} for i in range(int(query["rows"][0]))] if n < 5 else []
            body = json.dumps({"status": "ok", "message": {"next-cursor": str(n + 1), "total-results": 10, "items": items}}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            if n == 2 and not state["cut"]:
                state["cut"] = True
                body = body[:20]
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    httpd = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}/works?filter=x"
    httpd.shutdown()


def test_cursor_reader(server):
    reader = cursor_pages.CursorPagesReader({"url": server, "rows": "2", "pagesPerBatch": "4", "pauseFactor": "0.05"})
    start = reader.initialOffset()
    pages, middle = reader.read(start)
    assert [m for m, _ in pages] == [f"works-page-{i}-offset-{2 * i}.json" for i in range(4)] and not middle["done"]
    rest, end = reader.read(middle)
    assert len(list(rest)) == 2 and end["done"]
    again, same = reader.read(end)
    assert list(again) == [] and same == end
    assert len(list(reader.readBetweenOffsets(start, middle))) == 4
    with pytest.raises(ValueError):
        cursor_pages.CursorPagesReader({"url": server, "rows": "3"}).read(end)


def test_page_stream_lands_every_page_once(spark, tmp_path, server):
    for _ in range(2):  # the second run goes on from the checkpoint and finds nothing new
        query = incremental.land_pages(incremental.page_stream(spark, server, rows=2, pagesPerBatch=2, pauseFactor=0.05), str(tmp_path / "pages"), str(tmp_path / "ck"))
        query.processAllAvailable()
        query.stop()
    members = [r["member"] for r in spark.read.parquet(str(tmp_path / "pages")).collect()]
    assert sorted(members) == [f"works-page-{i}-offset-{2 * i}.json" for i in range(6)]


MESSAGES = "doi string, t timestamp, row_id bigint"


def _message_files(spark, folder, batches):
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(d, datetime(2019, 1, 1) + timedelta(days=t), r) for d, t, r in rows], MESSAGES)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    return spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_streaming_forms(spark, tmp_path):
    stream = _message_files(spark, str(tmp_path / "in"), [[("a", 1, 1), ("b", 1, 2)], [("a", 2, 3), ("c", 30, 4)], [("d", 60, 5)]])
    store = DeliveryStore(spark, scratch_path(spark, "stream"), identifier="doi", order=["t", "row_id"], columns=[])
    query = incremental.merge_stream(stream, store, str(tmp_path / "ck1"))
    query.processAllAvailable()
    query.stop()
    assert {r["doi"]: r["row_id"] for r in store.read().collect()} == {"a": 1, "b": 2, "c": 4, "d": 5}
    query = incremental.first_deliveries(stream, "doi", "t").writeStream.format("memory").queryName("first_seen").option("checkpointLocation", str(tmp_path / "ck2")).start()
    query.processAllAvailable()
    query.stop()
    assert {r["row_id"] for r in spark.table("first_seen").collect()} == {1, 2, 4, 5}
    query = incremental.counts_by_period(stream, "doi", "t").writeStream.format("memory").queryName("periods").option("checkpointLocation", str(tmp_path / "ck3")).start()
    query.processAllAvailable()
    query.stop()
    assert {(r["doi"], r["n_messages"]) for r in spark.table("periods").collect()} == {("a", 1), ("b", 1), ("c", 1)}


def test_pauses_grow_up_to_a_limit():
    assert [cursor_pages.pause_before(n, 1.0, 120.0) for n in (0, 1, 2, 3, 9)] == [0, 0, 2, 4, 120]


def test_zip_by_uri(spark, tmp_path):
    path = str(tmp_path / "pages.zip")
    zip_pages.append_to_zip(spark.createDataFrame([(f"p{i}", f"{{{i}}}") for i in range(20)], "member string, content string").coalesce(1), path, "deflate")
    for name in (path, f"file://{path}"):
        assert sorted((r["member"], r["content"]) for r in zip_pages.read_zip(spark, name).collect()) == sorted((f"p{i}", f"{{{i}}}") for i in range(20))


def test_utc_now(spark):
    now = spark.range(1).select(text.utc_now().alias("t")).first()["t"]
    assert abs((datetime.strptime(now, "%Y-%m-%dT%H:%M:%SZ") - datetime.now(UTC).replace(tzinfo=None)).total_seconds()) < 60
