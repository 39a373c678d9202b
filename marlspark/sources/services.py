"""Remote services: rate limit, retry rules, and their payloads as rows. The transport is the caller's."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Calls a second without and with a key, and ids of a batch.
CALLS_A_SECOND, CALLS_A_SECOND_KEYED, BATCH = 0.33, 1.0, 500
# Answers worth another try, of lookups and of pages.
LOOKUP_AGAIN, PAGE_AGAIN = (500, 502, 503, 504), (429, 502, 503, 504)
NETWORK = 0  # stands for a failure without an answer

PAPER = "paperId string, title string, abstract string, year int, venue string, externalIds struct<DOI: string, ArXiv: string>, publicationDate string, fieldsOfStudy array<string>, citationCount long"


class RateLimit:
    """Spaces the calls of one process by 1 / ``a_second``."""

    def __init__(self, a_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep, self.last = 1.0 / a_second, clock, sleep, None

    def wait(self) -> None:
        if self.last is not None and (left := self.last + self.gap - self.clock()) > 0:
            self.sleep(left)
        self.last = self.clock()


def lookup_wait(code: int, attempt: int, retries: int = 3, retry_after: float | None = None) -> float | None:
    """Seconds to wait after a failed lookup (attempts from 0), or None to give up: 429 as told or by doubling up to a minute."""
    if code == 429:
        return float(retry_after) if retry_after else float(min(2 ** (attempt + 2), 60))
    return float(2 ** (attempt + 1)) if (code == NETWORK or code in LOOKUP_AGAIN) and attempt < retries - 1 else None


def page_wait(code: int, attempt: int, retries: int = 3) -> float | None:
    """The same for pages: two seconds more at each attempt."""
    return 2.0 * (attempt + 1) if (code == NETWORK or code in PAGE_AGAIN) and attempt < retries else None


def lookup_wait_column(code: Column, attempt: Column, retry_after: Column, retries: int = 3) -> Column:
    """``lookup_wait`` over a table of answers."""
    double = lambda n: F.pow(F.lit(2.0), attempt + n)
    told = F.when(retry_after.isNotNull() & (retry_after != 0), retry_after.cast("double"))
    again = code.isin(NETWORK, *LOOKUP_AGAIN) & (attempt < retries - 1)
    return F.when(code == 429, F.coalesce(told, F.least(double(2), F.lit(60.0)))).when(again, double(1))


def fetch_json(get: Callable[[], tuple[int, str, float | None]], limit: RateLimit, retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> dict | None:
    """A lookup's parsed answer, None for 404. ``get`` returns a code, the body and what Retry-After says."""
    for attempt in range(retries):
        limit.wait()
        code, body, after = get()
        if 200 <= code < 300:
            return json.loads(body)
        if code == 404:
            return None
        wait = lookup_wait(code, attempt, retries, after)
        if wait is None:
            raise OSError(f"lookup failed with {code}: {body}")
        sleep(wait)
    raise OSError(f"lookup failed after {retries} tries")


def search_results(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows of stored search answers, single or bulk: ``place``, the paper's fields, and ``total`` (the list's length where it is not told).

    A null, unparsable or empty answer has no rows.
    """
    kept = [c for c in payloads.columns if c != payload]
    parsed = payloads.select(*kept, F.from_json(payload, f"total long, token string, data array<struct<{_fields(PAPER)}>>").alias("p"))
    rows = parsed.select(*kept, F.coalesce("p.total", F.size("p.data").cast("long")).alias("total"), F.col("p.token").alias("token"), F.posexplode("p.data").alias("place", "paper"))
    return rows.select(*kept, "total", "token", "place", "paper.*")


def paper_results(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each stored answer of a lookup by id; ``found`` is false where there is none."""
    kept = [c for c in payloads.columns if c != payload]
    parsed = payloads.select(*kept, F.from_json(payload, PAPER).alias("p"))
    return parsed.select(*kept, F.coalesce(F.col("p.paperId").isNotNull(), F.lit(False)).alias("found"), "p.*")


def works(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """abstract of stored registry answers, without its markup; blank where there is none."""
    from ..functions.text import strip_jats

    kept = [c for c in payloads.columns if c != payload]
    raw = F.from_json(payload, "message struct<abstract: string>")["message"]["abstract"]
    return payloads.select(*kept, F.trim(F.coalesce(strip_jats(raw), F.lit(""))).alias("abstract"))


def _fields(ddl: str) -> str:
    from pyspark.sql.types import StructType

    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in StructType.fromDDL(ddl))
