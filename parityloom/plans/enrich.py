"""Texts from a client, batch by batch: a pluggable interface, isolated failures, score and rewrite."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

Client = Callable[[str], str]


def mock_client(prompt: str) -> str:
    """A client that has nothing to say; rows get the status mock."""
    return ""


def retried(client: Client, tries: int = 3, wait: float = 0.0) -> Client:
    def call(prompt: str) -> str:
        for i in range(tries):
            try:
                return client(prompt)
            except Exception:  # noqa: BLE001  the last failure is raised
                if i == tries - 1:
                    raise
                time.sleep(wait * 2**i)
        return ""

    return call


def enrich(df: DataFrame, prompt: Column, make_client: Callable[[], Client], per_second: float | None = None) -> DataFrame:
    """df with response and status (generated, mock or failed).

    A task makes its own client. A row that fails keeps the others; the rate is
    that of one task, so of all of them times the tasks at work.
    """
    schema = StructType([*df.schema, StructField("response", StringType()), StructField("status", StringType())])
    wait = 1.0 / per_second if per_second else 0.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for b in batches:
            answers, states = [], []
            for text in b.pop("prompt_"):
                try:
                    answer = client(text or "")
                    answers.append(answer)
                    states.append("generated" if answer else "mock")
                except Exception:  # noqa: BLE001  one row's failure is its status
                    answers.append(None)
                    states.append("failed")
                time.sleep(wait)
            yield b.assign(response=answers, status=states)

    return df.withColumn("prompt_", prompt).mapInPandas(run, schema)


def best_of(make_client: Callable[[], Client], score: Callable[[str], float], rewrite: Callable[[str, str], str], accept: float, rounds: int = 3) -> Callable[[], Client]:
    """A client that asks again, with a rewritten prompt, until the answer's score is at most accept."""

    def make() -> Client:
        ask = make_client()

        def client(prompt: str) -> str:
            best, low = "", float("inf")
            for _ in range(rounds):
                answer = ask(prompt)
                if (s := score(answer)) < low:
                    best, low = answer, s
                if low <= accept:
                    break
                prompt = rewrite(prompt, answer)
            return best

        return client

    return make


def policy(confidence: Column, deviation: Column) -> Column:
    """accept, rewrite or skip: texts that say little are not judged, those that say some may be further off."""
    return F.when(confidence < 0.35, "skip").when((confidence < 0.6) & (deviation <= 25), "accept").when(deviation <= 15, "accept").otherwise("rewrite")


def judged(answer: Column, aspects: tuple[str, ...], least: float = 3.0) -> Column:
    """All aspects of a judge's JSON answer have at least the least score."""
    from ..functions.nested import lenient_field

    scores = F.array(*[lenient_field(answer, a, "0").try_cast("double") for a in aspects])
    return F.forall(scores, lambda s: F.coalesce(s, F.lit(0.0)) >= least)


def narrative_status(df: DataFrame, status: str) -> DataFrame:
    """Counts and ratios by status."""
    from ..operators.profile import shares

    return shares(df, F.col(status))


def regression(make: Callable[[Mapping], str], cases: list[tuple[Mapping, Callable[[str], bool]]]) -> list[int]:
    """Numbers of the cases that fail."""
    return [i for i, (given, ok) in enumerate(cases) if not ok(make(given))]
