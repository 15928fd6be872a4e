"""Listing pages as a Python data source, politely fetched."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .client import Client, RobotsGate, fetch

__all__ = ["ListingSource", "RobotsGate", "fetch"]


class ListingSource(DataSource):
    """Options: url (form target), years (comma-separated), agent, spacing, jitter, retries, backoff, field (form field of the year, `year`).

    All years are one partition: a site is asked one thing at a time, so its spacing holds for the run and not for each task. A year that cannot
    be fetched is a row with a null page.
    """

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "year int, html string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        years = tuple(int(y) for y in self.options["years"].split(",") if y.strip())
        return [InputPartition(years)] if years else []

    def client(self) -> Client:
        o = self.options
        return Client(o["url"], o.get("agent", "corpusloom"), float(o.get("spacing", "3")), float(o.get("jitter", "1.5")), retries=int(o.get("retries", "5")), backoff=float(o.get("backoff", "2")))

    def read(self, partition: InputPartition):
        client = self.client()
        client.warm_up()
        for year in partition.value:
            body = client.read(self.options["url"], {self.options.get("field", "year"): year})
            yield year, None if body is None else body.decode("utf-8", "replace")
