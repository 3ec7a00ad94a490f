"""Tables from services over HTTP: markup of PDF files, and whether a name is known.

A call is made where the row is; what it gives should be written down before it is used
twice, as a task that runs again asks again.
"""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import canonical_name
from marlstone.sources.calls import Ledger, Patience, in_flight, tasks_for


@dataclass(frozen=True)
class MarkupService:
    """The path and the fields that it is asked with."""

    url: str = "http://localhost:8070/api/processFulltextDocument"
    timeout: float = 6000.0
    fields: tuple[tuple[str, str], ...] = (("consolidateHeader", "1"), ("consolidateCitations", "1"), ("teiCoordinates", "false"))

    def ask(self, content: bytes) -> str:
        mark = uuid.uuid4().hex
        parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{n}"\r\n\r\n{v}\r\n'.encode() for n, v in self.fields]
        parts += [f'--{mark}\r\nContent-Disposition: form-data; name="input"; filename="input.pdf"\r\nContent-Type: application/pdf\r\n\r\n'.encode(), content, f"\r\n--{mark}--\r\n".encode()]
        request = urllib.request.Request(self.url, b"".join(parts), {"Content-Type": f"multipart/form-data; boundary={mark}"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            if answer.status != 200:
                raise RuntimeError(f"the service answered {answer.status}")
            return answer.read().decode("utf-8")


def markup(files: DataFrame, service: MarkupService | None = None) -> DataFrame:
    """(path, xml) of rows (path, content): a file the service refuses fails the job; a null
    content gives a null."""
    service = service or MarkupService()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"path": part["path"], "xml": [None if c is None else service.ask(bytes(c)) for c in part["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, xml string")


@dataclass(frozen=True)
class NameService:
    """A name is known if the answer to it is JSON with ``field``; any failure means no."""

    url: str = "https://pubchem.ncbi.nlm.nih.gov/rest/pug/compound/name/{}/cids/JSON"
    field: str = "IdentifierList"
    timeout: float = 4.0
    at_once: int = 30

    def asked(self, item: dict) -> tuple[str | None, str | None]:
        """true, false (as any refusal is), or null and why where no answer came."""

        def call() -> str:
            with urllib.request.urlopen(self.url.format(urllib.parse.quote(item["name"], safe="")), timeout=self.timeout) as answer:
                return str(answer.status == 200 and self.field in json.loads(answer.read())).lower()

        value, reason = Patience(attempts=1).tried(call)
        return ("false", reason) if reason and reason.startswith("status 4") and reason != "status 429" else (value, reason)

    def knows(self, name: str) -> bool:
        return self.asked({"name": name})[0] == "true"


def looked_up(names: DataFrame, known: DataFrame, service: NameService | None = None, ledger: str | None = None) -> DataFrame:
    """(name, valid) of the distinct canonical names: those in ``known`` (a dimension, column
    name) are valid, the others are asked for, each once; with ``ledger``, a path that
    stays, once over all runs. Failures count as no, and are asked again in a later run."""
    service = service or NameService()
    distinct = names.select(canonical_name(F.col("name")).alias("name")).where("name <> ''").distinct()
    sure = known.select(canonical_name(F.col("name")).alias("name")).distinct()
    open_ = distinct.join(sure, "name", "left_anti")

    found = distinct.join(sure, "name", "left_semi").withColumn("valid", F.lit(True))
    if ledger:
        answers = Ledger(names.sparkSession, ledger, ("name",), "known").ask(open_, service.asked, service.at_once)
        return found.union(open_.join(answers, "name", "left").select("name", F.coalesce(F.col("known") == "true", F.lit(False)).alias("valid")))
    tasks, at_once = tasks_for(names.sparkSession, service.at_once)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            told = dict(in_flight(iter(part["name"]), service.knows, at_once))
            yield part.assign(valid=[told[n] for n in part["name"]])

    return found.union(open_.repartition(tasks).mapInPandas(run, "name string, valid boolean"))
