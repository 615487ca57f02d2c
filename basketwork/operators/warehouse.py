"""The four warehouse tables and lookups between them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from basketwork.operators.joins import attach, column_bytes

KEYS = {
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_campaigns": "campaign_id",
    "fact_sales_transactions": "transaction_id",
}


@dataclass
class Warehouse:
    """Star schema as built by `star`: keys are unique in all four tables.

    Because `transaction_id` is unique in the fact and every dimension key is
    unique, joins do not multiply sales and a distinct count of transactions is
    a plain count.
    """

    customers: DataFrame
    products: DataFrame
    campaigns: DataFrame
    sales: DataFrame
    _bytes: dict[str, dict[str, int]] = field(default_factory=dict, repr=False)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_customers": self.customers,
            "dim_products": self.products,
            "dim_campaigns": self.campaigns,
            "fact_sales_transactions": self.sales,
        }

    def size(self, table: str, columns: list[str]) -> int:
        """Measured bytes of some columns of a dimension; each table is measured once."""
        if table not in self._bytes:
            self._bytes[table] = column_bytes(self.tables[table])
        return sum(self._bytes[table][name] for name in columns)

    def attach(self, rows: DataFrame, table: str, columns: dict[str, str] | None = None, how: str = "left") -> DataFrame:
        """Add dimension columns (`{column: new name}`) to sales holding `transaction_id` and the key."""
        key, columns = KEYS[table], columns or {}
        dim = self.tables[table].select(key, *[self.tables[table][c].alias(n) for c, n in columns.items()])
        size = self.size(table, [key, *columns])
        return attach(rows, dim, key, how, size, salt_on="transaction_id", counted=self.sales)
