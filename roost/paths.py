"""Where the layers of the lake live."""

from __future__ import annotations

from dataclasses import dataclass

DATASETS = ("listings", "reviews", "bookings", "transactions")


@dataclass(frozen=True)
class LakePaths:
    """Base paths of the three layers, on any filesystem Spark can reach."""

    bronze: str
    silver: str
    gold: str

    @classmethod
    def under(cls, root: str) -> LakePaths:
        root = root.rstrip("/")
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold")

    def raw(self, dataset: str) -> str:
        return f"{self.bronze.rstrip('/')}/{dataset}"

    def landed(self, dataset: str, ingest_date: str) -> str:
        return f"{self.raw(dataset)}/ingest_date={ingest_date}"

    def clean(self, dataset: str) -> str:
        return f"{self.silver.rstrip('/')}/{dataset}"

    def mart(self, name: str) -> str:
        return f"{self.gold.rstrip('/')}/{name}"
