"""Table schemas: the raw (all-string) read schemas and the typed field
rules the validator checks (SURVEY §1.2, §2.5)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COLUMN = "_corrupt_record"


@dataclass(frozen=True)
class Field:
    """One column rule: kind is int | float | str | datetime; ``ge`` is a
    lower bound; optional fields accept NULL."""

    name: str
    kind: str
    required: bool = True
    ge: float | None = None
    spark_type: str = "string"


@dataclass(frozen=True)
class Schema:
    name: str
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def raw_struct(self, corrupt: bool = True) -> StructType:
        """All-string read schema in file column order, plus the corrupt
        record column that PERMISSIVE CSV mode fills for malformed lines."""
        cols = [StructField(f.name, StringType(), True) for f in self.fields]
        if corrupt:
            cols.append(StructField(CORRUPT_COLUMN, StringType(), True))
        return StructType(cols)


# The reference's three row schemas, in file column order.
ORDERS = Schema("orders", (
    Field("order_id", "int", spark_type="bigint"),
    Field("order_date", "datetime", spark_type="timestamp_ntz"),
    Field("product_id", "int", spark_type="bigint"),
    Field("qty", "int", ge=0, spark_type="bigint"),
    Field("unit_price", "float", ge=0, spark_type="decimal(28,6)"),
    Field("user_id", "int", required=False, spark_type="bigint"),
    Field("order_status", "str", required=False, spark_type="string"),
))

PRODUCTS = Schema("products", (
    Field("product_id", "int", spark_type="bigint"),
    Field("product_name", "str", spark_type="string"),
    Field("category", "str", required=False, spark_type="string"),
    Field("price", "float", ge=0, spark_type="decimal(28,6)"),
))

INVENTORY = Schema("inventory", (
    Field("product_id", "int", spark_type="bigint"),
    Field("warehouse_id", "str", spark_type="string"),
    Field("stock_on_hand", "int", ge=0, spark_type="bigint"),
    Field("last_restock_date", "datetime", spark_type="timestamp_ntz"),
))
