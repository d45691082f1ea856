"""Documents fetched over HTTP by tasks: allowed schemes, size limit, rate limit, retries, content hash."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.functions import checks
from chainloom.operators.offchain import verified

RATE, RETRIES, TIMEOUT = 10.0, 3, 30.0


def fetch(refs: DataFrame, key: str, url: str = "url", expected: str = "hash", rate: float = RATE, tasks: int = 1, retries: int = RETRIES, pause: float = 0.5) -> DataFrame:
    """key, url, body, error, attempts and valid of each reference.

    ``rate`` requests a second are made in all: each of ``tasks`` tasks makes its share. A refused URL or a failure
    leaves a reason in ``error``; a body is valid if its SHA-256 is the expected one.
    """
    kind = dict(refs.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        next_at = 0.0
        for batch in batches:
            out = []
            for k, u, h, reason in batch.itertuples(index=False):
                body, error, attempts = None, reason, 0
                while error is None and body is None and attempts < retries:
                    attempts += 1
                    time.sleep(max(0.0, next_at - time.monotonic()))
                    next_at = time.monotonic() + tasks / rate
                    try:
                        with urllib.request.urlopen(u, timeout=TIMEOUT) as answer:
                            data = answer.read(checks.BODY_BYTES + 1)
                        if len(data) > checks.BODY_BYTES:
                            error = "body too large"
                        else:
                            body = data
                    except urllib.error.HTTPError as e:
                        error = f"status {e.code}" if e.code < 500 or attempts == retries else None
                    except OSError as e:
                        error = type(e).__name__ if attempts == retries else None
                    if error is None and body is None:
                        time.sleep(pause * attempts)
                out.append((k, u, h, body, error, attempts))
            yield pd.DataFrame(out, columns=[key, url, expected, "body", "error", "attempts"])

    asked = refs.select(key, url, expected, checks.url(F.col(url)).alias("reason")).repartition(tasks)
    got = asked.mapInPandas(run, f"`{key}` {kind}, `{url}` string, `{expected}` string, body binary, error string, attempts int")
    return verified(got, "body", expected)
