"""Records of an open-data portal with the Explore v2.1 interface, as a Spark data source.

The portal filters by partition and counts on its side; each partition is one input partition here.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib import error, parse, request

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from registra.schema import RAW

RETRIED = frozenset({429, 500, 502, 503, 504})
PAGE = 100  # groups asked for at once; a shorter answer is the last


class PortalError(RuntimeError):
    """The portal refused a request, or went on failing."""


def fetch(url: str, tries: int = 4, backoff: float = 2.0, timeout: float = 60.0, pause: Callable[[float], None] = time.sleep) -> bytes:
    """The body behind ``url``. Lost connections, time-outs, 429 and 5xx are tried again after growing pauses; any other refusal raises at once."""
    for attempt in range(tries):
        try:
            with request.urlopen(url, timeout=timeout) as answer:
                return answer.read()
        except error.HTTPError as e:
            if e.code not in RETRIED:
                raise PortalError(f"{url}: {e.code}") from e
            last: Exception = e
        except (error.URLError, TimeoutError, ConnectionError) as e:
            last = e
        if attempt + 1 < tries:
            pause(backoff**attempt)
    raise PortalError(f"{url}: gave up after {tries} tries") from last


def decode_year(label: str) -> int:
    """``24`` is 2024, ``80`` is 1980; four digits stay."""
    year = int(label)
    return year + 2000 if year < 80 else year + 1900 if year < 100 else year


def encode_year(year: int | str) -> str:
    """The two-digit label the portal keeps a year under."""
    return f"{int(year) % 100:02d}"


@dataclass(frozen=True)
class Portal:
    """One dataset of a portal: how it is asked and how its answers read."""

    base: str
    dataset: str
    partition: str = "folderyear"
    watermark: str = "extractdate"
    get: Callable[[str], bytes] = fetch

    def _url(self, tail: str, **query: str | int) -> str:
        asked = f"?{parse.urlencode(query)}" if query else ""
        return f"{self.base.rstrip('/')}/api/explore/v2.1/catalog/datasets/{parse.quote(self.dataset)}{tail}{asked}"

    def where(self, label: str) -> str:
        return f'{self.partition}="{label}"'

    def export_url(self, label: str) -> str:
        return self._url("/exports/json", where=self.where(label), limit=-1)

    def metadata(self) -> dict:
        """Row count and dates that the publisher states."""
        stated = json.loads(self.get(self._url(""))).get("metas", {}).get("default", {})
        return {k: stated.get(k) for k in ("records_count", "modified", "data_processed")}

    def discover(self, first_year: int | None = None) -> list[tuple[str, int]]:
        """Partition labels and their row counts, in order, from ``first_year`` on."""
        rows: list[dict] = []
        while True:
            query = {"select": f"{self.partition}, count(*) as n", "group_by": self.partition, "order_by": self.partition, "limit": PAGE, "offset": len(rows)}
            page = json.loads(self.get(self._url("/records", **query))).get("results", [])
            rows += page
            if len(page) < PAGE:
                break
        found = [(str(r[self.partition]), int(r["n"])) for r in rows if r.get(self.partition) is not None]
        return [f for f in found if first_year is None or decode_year(f[0]) >= first_year]

    def probe(self, label: str) -> tuple[int, str | None]:
        """Row count and greatest watermark of a partition, counted by the portal."""
        answer = json.loads(self.get(self._url("/records", select=f"count(*) as n, max({self.watermark}) as w", where=self.where(label), limit=1)))
        row = (answer.get("results") or [{}])[0]
        return int(row.get("n") or 0), row.get("w")

    def received(self, label: str) -> bytes:
        """All records of a partition as the publisher sends them."""
        return self.get(self.export_url(label))

    def export(self, label: str) -> list[dict]:
        """All records of a partition."""
        return json.loads(self.received(label))


def as_text(value: object) -> str | None:
    """A field as the raw layer keeps it: text as it is, nested values as JSON, null as null."""
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


@dataclass
class PortalPartition(InputPartition):
    label: str


class PortalReader(DataSourceReader):
    def __init__(self, portal: Portal, schema: StructType, labels: list[str] | None, first_year: int | None) -> None:
        self.portal, self.names, self.labels, self.first_year = portal, schema.names, labels, first_year

    def partitions(self) -> list[InputPartition]:
        labels = self.labels if self.labels is not None else [label for label, _ in self.portal.discover(self.first_year)]
        return [PortalPartition(label) for label in labels]

    def read(self, partition: PortalPartition) -> Iterator[tuple]:
        for record in self.portal.export(partition.label):
            yield tuple(as_text(record.get(n)) for n in self.names)


class PortalSource(DataSource):
    """``spark.read.format("explore_portal").option("base", ...).option("dataset", ...)``; ``partitions`` (comma list) and ``first_year`` are optional."""

    @classmethod
    def name(cls) -> str:
        return "explore_portal"

    def schema(self) -> StructType:
        return RAW

    def reader(self, schema: StructType) -> PortalReader:
        o = self.options
        labels = [x.strip() for x in o["partitions"].split(",")] if o.get("partitions") else None
        return PortalReader(Portal(o["base"], o["dataset"]), schema, labels, int(o["first_year"]) if o.get("first_year") else None)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PortalSource)
