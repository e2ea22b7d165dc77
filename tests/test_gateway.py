"""Clients against a server of our own, tool calls, and what answers become; files and logs."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from reportloom.operators import extract
from reportloom.sources import files, gateway


class Handler(BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Handler.seen.append((self.path, body, {k.lower(): v for k, v in self.headers.items()}))
        status, out = 200, {}
        if self.path == "/v1/responses" and body.get("stream"):
            events = [{"type": "response.created", "response": {"id": "r1"}}, {"type": "response.output_text.delta", "delta": "一"}, {"type": "response.output_text.delta", "delta": "b"}]
            if body["input"] == "fail":
                events.append({"type": "response.failed"})
            raw = "data: nonsense\n\n: note\n" + "".join(f"data: {json.dumps(e)}\n\n" for e in events) + "data: [DONE]\n"
            raw = raw.encode()
        else:
            if self.path == "/v1/responses":
                status, out = (500, {}) if body["input"] == "broken" else (200, {"output": [{"content": f"echo {body['input']}"}]})
            elif self.path == "/api/chat":
                out = {"message": {"content": json.dumps({"form": "format" in body, "asked": body["messages"][0]["content"]})}}
            elif body["tool"] == "none":
                status = 404
            elif body["tool"] == "bad":
                status = 500
            else:
                out = {"ok": True, "result": body}
            raw = json.dumps(out).encode()
        self.send_response(status)
        self.send_header("Content-Length", str(len(raw)))
        self.end_headers()
        self.wfile.write(raw)

    def log_message(self, *_):
        pass


@pytest.fixture
def url():
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()
    server.server_close()


def test_token(monkeypatch):
    monkeypatch.setenv("SECOND", "s")
    assert gateway.token("given", "FIRST") == "given" and gateway.token(None, "FIRST", "SECOND") == "s"
    with pytest.raises(ValueError):
        gateway.token(None, "FIRST")
    with pytest.raises(FileNotFoundError):
        gateway.read_prompt("/nowhere/prompt.md")


def test_responses(spark, url):
    make = gateway.Responses(url, "t", "me", "x-agent", model="m", instructions="i", max_output_tokens=9)
    Handler.seen.clear()
    rows = spark.createDataFrame([(1, "a", "s1"), (2, "broken", "s2")], "doc_id int, prompt string, session string").coalesce(1)
    got = extract.ask(rows, make, attempts=2, wait=0).sort("doc_id").collect()
    assert extract.response_text(spark.createDataFrame([(1, got[0].answer)], "doc_id int, response string")).first().text == "echo a"
    assert (got[1].answer, got[1].attempt) == (None, 2) and "HTTP 500" in got[1].error
    path, body, headers = Handler.seen[0]
    assert body == {"model": "m", "input": "a", "instructions": "i", "max_output_tokens": 9}
    assert [headers[k] for k in ("authorization", "x-agent-agent-id", "x-agent-session-key", "x-agent-model")] == ["Bearer t", "me", "s1", "m"]


def test_stream(url):
    call = gateway.Responses(url, "t", "me", "x-agent", stream=True)()
    assert json.loads(call("a")) == {"id": "r1", "status": "created", "output_text": "一b"}
    with pytest.raises(RuntimeError, match="response failed"):
        call("fail")
    assert gateway.streamed(['data: {"type": "response.completed", "response": {"id": 3}}', "data: {"]) == {"id": 3}
    assert gateway.streamed([]) == {"id": None, "status": "unknown", "output_text": ""}


def test_chat(url):
    assert json.loads(gateway.Chat(url, "m", extract.CONTENTS_FORM)()("q")) == {"form": True, "asked": "q"}


def test_invoke(spark, url):
    rows = [(1, "search", '{"q": "x"}', None), (2, "none", None, None), (3, "bad", None, None), (4, "search", "no json", None), (5, "search", None, "go")]
    got = gateway.invoke(spark.createDataFrame(rows, "k int, tool string, args string, action string"), url, "t").sort("k").collect()
    assert [(r.ok, r.error_type) for r in got] == [(True, None), (False, "tool_not_found"), (False, "RuntimeError"), (False, "JSONDecodeError"), (True, None)]
    assert json.loads(got[0].result) == {"tool": "search", "args": {"q": "x"}} and json.loads(got[4].result) == {"tool": "search", "action": "go"}
    nobody = gateway.invoke(spark.createDataFrame([(1, "search")], "k int, tool string"), "http://127.0.0.1:9", "t").first()
    assert not nobody.ok and nobody.error


def test_regions(spark):
    docs = spark.createDataFrame([(1, "标题a\n正文𠮷\n标题b\n标题a"), (2, None)], "doc_id int, text string")
    regions = spark.createDataFrame([(1, 0, 4), (1, 4, 15), (2, 0, 9)], "doc_id int, start int, end int")
    asked = extract.region_prompts(docs, regions, "{start}-{end}\n{sections}\n{text}", {"甲": "x, y"}).sort("doc_id", "start").collect()
    assert [r.prompt for r in asked] == ["0-4\n- 甲: x, y\n标题a\n", "4-15\n- 甲: x, y\n正文𠮷\n标题b\n标题a", "0-9\n- 甲: x, y\n"]
    said = [(1, 4, '```json\n[{"raw_title": "标题a", "canonical_name": "甲"}, {"raw_title": "标题a"}]\n```'), (1, 4, '[{"raw_title": "无", "canonical_name": "乙"}]'), (1, 0, "none"), (1, 0, None), (2, 7, '[{"raw_title": "", "canonical_name": "丙"}]')]
    got = extract.region_boundaries(docs, spark.createDataFrame(said, "doc_id int, start int, answer string"))
    assert sorted(map(tuple, got.collect())) == [(1, 4, "无", "乙", 0.9), (1, 12, "标题a", "甲", 0.9), (2, 7, "", "丙", 0.9)]


def test_contents_answers(spark):
    good = '{"sections": [{"order": 2, "raw_title": "b", "canonical_name": "乙"}, {"order": 1, "raw_title": "a", "canonical_name": null}]}'
    said = [(1, good), (2, '{"sections": [{"raw_title": "b", "canonical_name": "乙"}]}'), (3, "text"), (4, None)]
    got = extract.contents_answers(spark.createDataFrame(said, "doc_id int, answer string"))
    assert list(map(tuple, got.collect())) == [(1, 2, "b", "乙")]


def test_message(spark):
    row = spark.createDataFrame([("000004_ST_国华_2025",)], "d string").select(extract.message("{doc_id}|{code}|{name}|{year}|{at}", F.col("d"), at=F.lit("/x")).alias("m")).first()
    assert row.m == "000004_ST_国华_2025|000004|ST_国华|2025|/x"


def test_sinks(spark, tmp_path):
    p = lambda x: str(tmp_path / x)
    s = spark.createDataFrame([("d1", 40, "甲、乙/丙", "x"), ("d2", None, "丁", "y")], "doc_id string, ord int, canonical string, content string")
    files.write_sections(s, p("s"))
    assert sorted(r.file for r in spark.read.parquet(p("s")).collect()) == ["d1/040_甲_乙_丙.txt", "d2/999_丁.txt"]
    assert spark.read.parquet(p("s")).filter(F.col("folder") == files.folder_of()).count() == 2
    files.write_sections(s, p("f"), flat=True)
    assert sorted(r.file for r in spark.read.parquet(p("f")).collect()) == ["d1_040_甲_乙_丙.txt", "d2_999_丁.txt"]
    details = spark.createDataFrame([("b", "success", 2), ("a", "failed", 0)], "doc_id string, status string, status_rank int")
    files.write_report(details.groupBy().agg(F.count("*").alias("n")), p("r"), details)
    assert files.read_report(spark, p("r"), "n int").first().n == 2
    assert [json.loads(x.value)["doc_id"] for x in spark.read.text(p("r_details")).collect()] == ["a", "b"]
    assert files.read_report(spark, p("none"), "n int").count() == 0
    files.write_tables({"blocks": s, "labels": details}, p("t"), readable=("labels",))
    assert spark.read.parquet(p("t/blocks")).count() == 2 and spark.read.json(p("t/labels_json")).count() == 2
    log = lambda *rows: files.append_new(spark.createDataFrame(rows, "doc_id string, reason string"), p("log"))
    log(("a", "1"), ("a", "2"), (None, "3"))
    log(("a", "9"), ("b", "1"))
    assert sorted(map(tuple, spark.read.parquet(p("log")).collect())) == [("a", "1"), ("b", "1")]


def test_section_files(spark, tmp_path):
    for name in ("d1/010_甲.txt", "d1/090_乙_丙.txt", "d1/x_y.txt", "_log/010_z.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("文" * len(name))
    found = files.read_section_files(spark, str(tmp_path), numbered=True)
    assert [r.doc_id for r in files.listed(found).collect()] == ["d1"]
    row = files.section_sizes(found).filter("doc_id = 'd1'").first()
    assert row.numbers == ["010", "090"] and row.sizes == {"010": 3 * len("d1/010_甲.txt"), "090": 3 * len("d1/090_乙_丙.txt")}
