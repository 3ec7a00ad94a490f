"""Calls of a service: how many are in flight, what is asked again, what is kept."""

import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from marlstone.sources import responses, services
from marlstone.sources.calls import Ledger, Patience, in_flight


class Service:
    """A local service that counts what it is asked, and how many requests it has at once."""

    def __init__(self, delay=0.0, fail=lambda n, prompt: 0):
        self.asked, self.now, self.most, lock = Counter(), 0, 0, threading.Lock()
        service = self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                self.answer(json.loads(self.rfile.read(int(self.headers["Content-Length"])))["prompt"])

            def do_GET(self):
                self.answer(self.path[1:])

            def answer(self, prompt):
                with lock:
                    service.asked[prompt] += 1
                    service.now += 1
                    service.most = max(service.most, service.now)
                    n = service.asked[prompt]
                time.sleep(delay)
                with lock:
                    service.now -= 1
                status = fail(n, prompt) or 200
                body = json.dumps({"response": f"re {prompt}", "IdentifierList": {}}).encode()
                self.send_response(status)
                self.end_headers()
                if status == 200:
                    self.wfile.write(body)

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"


@pytest.fixture
def prompts(spark):
    return spark.createDataFrame([(i, "m", f"p{i % 60}") for i in range(120)], "doc_id int, model string, prompt string").repartition(5)


def test_in_flight_takes_no_more_than_told():
    now, most, taken = [0], [0], [0]
    lock = threading.Lock()

    def items():
        for i in range(50):
            taken[0] += 1
            yield i

    def call(i):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return i * i

    done = 0
    for i, square in in_flight(items(), call, 7):
        done += 1
        assert square == i * i and taken[0] - done <= 7
    assert done == 50 and 2 <= most[0] <= 7


def test_calls_run_together(prompts):
    service = Service(delay=0.2)
    got = responses.Http(responses.Client(host=service.url, at_once=30)).responses(prompts).collect()
    assert {r.response for r in got} == {f"re p{i}" for i in range(60)} and len(got) == 120
    assert 8 < service.most <= 30


def test_second_run_asks_nothing(spark, prompts, tmp_path):
    service = Service()
    source = responses.Http(responses.Client(host=service.url), ledger=f"file://{tmp_path}/ledger")
    for _ in range(2):
        got = source.responses(prompts).collect()
        assert len(got) == 120 and all(r.response == f"re {r.prompt}" and r.reason is None for r in got)
        assert sum(service.asked.values()) == 60 and set(service.asked.values()) == {1}
    more = spark.createDataFrame([(1, "m", "new"), (1, "other", "p1"), (2, "m", "p2")], prompts.schema)
    assert source.responses(more).count() == 3 and sum(service.asked.values()) == 62


def test_failed_run_keeps_what_it_wrote(spark, prompts, tmp_path):
    class Broken(Exception):
        pass

    asked = tmp_path / "asked"
    asked.mkdir()

    def call(item):
        with open(asked / item["prompt"], "a") as f:
            f.write("x")
        if item["prompt"] == "p33" and not (asked / "well").exists():
            raise Broken
        return f"re {item['prompt']}", None

    ledger = Ledger(spark, f"file://{tmp_path}/kept", ("model", "prompt"), "response")
    rows = prompts.select("model", "prompt")
    with pytest.raises(Exception, match="Broken"):
        ledger.ask(rows, call, 4, kept_every=1, run="one")
    written = {r.prompt for r in ledger.answers().collect()}
    assert written
    (asked / "well").write_text("")
    assert ledger.ask(rows, call, 4, run="one").count() == 60  # the same run again, as a task that is repeated
    counts = {f.name: len(f.read_text()) for f in asked.iterdir() if f.name != "well"}
    assert all(counts[p] == 1 for p in written) and set(counts.values()) <= {1, 2}
    assert ledger.ask(rows, call, 4).where("response IS NULL").count() == 0
    assert {f.name: len(f.read_text()) for f in asked.iterdir() if f.name != "well"} == counts


def test_service_that_recovers(prompts, tmp_path):
    service = Service(fail=lambda n, prompt: 503 if n == 1 else 404 if prompt == "p7" else 0)
    client = responses.Client(host=service.url, attempts=3, delay=0.01)
    got = {r.prompt: r for r in responses.Http(client, ledger=f"file://{tmp_path}/l").responses(prompts).collect()}
    assert got["p8"].response == "re p8" and service.asked["p8"] == 2
    assert got["p7"].response is None and got["p7"].reason == "status 404"
    refused = responses.Http(responses.Client(host="http://127.0.0.1:9", attempts=2, delay=0.01), ledger=f"file://{tmp_path}/r")
    assert "Error" in refused.responses(prompts).first().reason
    # failures are asked again in a later run
    again = responses.Http(client, ledger=f"file://{tmp_path}/r").responses(prompts).where("prompt <> 'p7'")
    assert again.where("response IS NULL").count() == 0


def test_connection_refused_then_served():
    tries = []

    def call():
        tries.append(1)
        if len(tries) < 3:
            raise ConnectionRefusedError
        return "here"

    assert Patience(4, 0.001).tried(call) == ("here", None)
    assert Patience(2, 0.001).tried(lambda: json.loads("{"))[0] is None


def test_names_are_kept(spark, tmp_path):
    service = Service(fail=lambda n, prompt: 404 if prompt == "bad" else 0)
    names = spark.createDataFrame([("Good",), ("good",), ("bad",), ("sure",), (None,)], "name string")
    sure = spark.createDataFrame([("sure",)], "name string")
    for _ in range(2):
        found = services.looked_up(names, sure, services.NameService(url=service.url + "/{}"), ledger=f"file://{tmp_path}/names")
        assert {(r.name, r.valid) for r in found.collect()} == {("good", True), ("bad", False), ("sure", True)}
        assert dict(service.asked) == {"good": 1, "bad": 1}
