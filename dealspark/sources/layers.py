"""SRC-4: one root, three layers — ``{root}/{raw|clean|curated}/{table}``.

The root may be any Hadoop file-system URI (``s3a://``, ``abfss://``,
``hdfs://``) or a local path; nothing here touches the file system.
"""

from __future__ import annotations

from dataclasses import dataclass

# Layer folder names of the layered layout.
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
SILVER_TABLES = {
    "leads": "leads_clean",
    "customers": "customers_clean",
    "interactions": "interactions_clean",
    "products": "products_clean",
}
GOLD_TABLES = ("customer_features", "sales_summary", "channel_performance", "top_customers")


@dataclass(frozen=True)
class Layout:
    root: str

    def _join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, entity: str) -> str:
        return self._join(BRONZE, entity)

    def silver(self, entity: str) -> str:
        return self._join(SILVER, SILVER_TABLES.get(entity, entity))

    def gold(self, table: str) -> str:
        return self._join(GOLD, table)
