"""Where a model's answers come from: a replay table, an HTTP service, or plain rules."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.operators import rules as R
from marlstone.sources.calls import Ledger, Patience, in_flight, tasks_for


@dataclass(frozen=True)
class Client:
    """How a service is asked."""

    host: str = "http://127.0.0.1:11434"
    timeout: float = 120.0
    most_timeout: float = 300.0
    chars_per_second: float = 20.0
    attempts: int = 2
    delay: float = 2.0
    at_once: int = 30  # calls in flight, of all tasks together

    def patience(self, prompt: str) -> float:
        return min(self.timeout + len(prompt) / self.chars_per_second, self.most_timeout)


class Replay:
    """Answers from a table (model, prompt_sha, response), by the SHA-256 of the prompt."""

    def __init__(self, answers: DataFrame):
        self.answers = answers

    def responses(self, prompts: DataFrame) -> DataFrame:
        asked = prompts.withColumn("prompt_sha", F.sha2("prompt", 256))
        return asked.join(self.answers.select("model", "prompt_sha", "response"), ["model", "prompt_sha"], "left").drop("prompt_sha")


class Http:
    """Answers from a service, several calls in flight; a request that fails in all attempts
    gives null, and ``reason`` says why. With ``ledger``, a path that stays, each prompt is
    asked once for each model, over runs and tasks that run again; without, write the result
    to a table before using it twice."""

    def __init__(self, client: Client | None = None, ledger: str | None = None):
        self.client, self.ledger = client or Client(), ledger

    def _asked(self, item: dict) -> tuple[str | None, str | None]:
        client, prompt = self.client, item["prompt"]
        body = json.dumps({"model": item["model"], "prompt": prompt, "stream": False}).encode()

        def call() -> str | None:
            request = urllib.request.Request(f"{client.host}/api/generate", body, {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=client.patience(prompt)) as answer:
                return json.loads(answer.read()).get("response")

        return Patience(client.attempts, client.delay).tried(call)

    def responses(self, prompts: DataFrame) -> DataFrame:
        client, asked = self.client, self._asked
        if self.ledger:
            rows = prompts.withColumn("prompt_sha", F.sha2("prompt", 256))
            kept = Ledger(prompts.sparkSession, self.ledger, ("model", "prompt_sha"), "response")
            answers = kept.ask(rows.select("model", "prompt_sha", "prompt"), asked, client.at_once)
            return rows.join(answers, ["model", "prompt_sha"], "left").drop("prompt_sha")
        tasks, at_once = tasks_for(prompts.sparkSession, client.at_once)

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                items = zip(range(len(part)), part["model"], part["prompt"], strict=True)
                found = dict(in_flight(({"at": i, "model": m, "prompt": p} for i, m, p in items), asked, at_once, lambda item: item["at"]))
                yield part.assign(response=[found[i][0] for i in range(len(part))], reason=[found[i][1] for i in range(len(part))])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields)
        return prompts.repartition(tasks).mapInPandas(run, f"{fields}, response string, reason string")


class Rules:
    """Answers made by rules from the evidence itself, in the JSON a model would give: one
    record per prompt with the first solvent, share and pair that the text holds."""

    def __init__(self, solvents: tuple[str, ...]):
        self.solvents = solvents

    def responses(self, prompts: DataFrame) -> DataFrame:
        low = T.norm_key(F.col("evidence"))
        found = F.array_join(F.filter(F.array(*[F.lit(s) for s in self.solvents]), lambda s: F.contains(low, s)), " / ")
        ratio = F.coalesce(R.pair_in_snippets(F.array("evidence")), R.ratio_in_solvent(F.col("evidence")))
        record = F.struct(
            F.struct(R.inferred_column(F.array("evidence")).alias("column_name")).alias("SP_FIELDS"),
            F.struct(F.nullif(found, F.lit("")).alias("solvent"), ratio["ratio"].alias("ratio"), ratio["units"].alias("ratio_units")).alias("SOL_FIELDS"),
        )
        return prompts.withColumn("response", F.to_json(F.struct(F.array(record).alias("conditions"))))
