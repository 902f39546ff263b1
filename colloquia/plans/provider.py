"""Model calls as data: a response table that requests are joined with, or a live endpoint on executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("step", "qid", "round")


def recorded(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with ``response`` and ``status`` (recorded or missing); of equal keys the least response counts."""
    table = responses.groupBy(*KEYS).agg(F.min("response").alias("response"), F.lit(True).alias("_hit"))
    joined = requests.join(table, list(KEYS), "left")
    return joined.withColumn("status", F.when(F.col("_hit"), "recorded").otherwise("missing")).drop("_hit")


def pending(requests: DataFrame, responses: DataFrame) -> DataFrame:
    return requests.join(responses, list(KEYS), "left_anti")


def live(requests: DataFrame, call: Callable[[str], str], parallel: int, tries: int = 5) -> DataFrame:
    """(step, qid, round, response, status): ``call(prompt)`` from at most ``parallel`` tasks.

    A call that fails ``tries`` times gives a null response and the error's name as status. Write
    the result once, keyed, and join it as recorded: retried tasks may call again.
    """

    def run(batches):
        import pandas as pd

        for rows in batches:
            out = []
            for row in rows.itertuples(index=False):
                response, status = None, "ok"
                for _ in range(tries):
                    try:
                        response, status = call(row.prompt), "ok"
                        break
                    except Exception as e:
                        status = type(e).__name__
                out.append((row.step, row.qid, row.round, response, status))
            yield pd.DataFrame(out, columns=[*KEYS, "response", "status"])

    return requests.select(*KEYS, "prompt").repartition(parallel).mapInPandas(run, "step string, qid long, round int, response string, status string")


def answered(requests: DataFrame, responses: DataFrame, call: Callable[[str], str], parallel: int, path: str) -> DataFrame:
    """All requests answered: what is missing is called once, written to ``path`` and joined like the rest."""
    live(pending(requests, responses), call, parallel).write.mode("append").parquet(path)
    new = requests.sparkSession.read.parquet(path).select(*KEYS, "response")
    return recorded(requests, responses.select(*KEYS, "response").unionByName(new))


def totals(answered_rows: DataFrame) -> DataFrame:
    """(step, status, n) of answered requests: how many calls succeeded, failed or are missing."""
    return answered_rows.groupBy("step", "status").agg(F.count("*").alias("n"))
