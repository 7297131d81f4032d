"""Synthetic tables for trying out a copy: large and partitioned, wide, empty, nested, oddly named.

Each table is a list of SQL expressions over ``id``; values come from hashes of it, so a table is
the same each time it is made, however it is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hash(seed: str) -> str:
    """A number from 0 to below 2**31, the same for a row and seed."""
    return f"pmod(xxhash64('{seed}', id), 2147483648)"


def _code(seed: str, kinds: int) -> str:
    """One of so many made-up codes, the first of them the most frequent."""
    return f"concat('{seed}', CAST(floor({kinds} * pow({_hash(seed)} / 2147483648D, 2)) AS INT))"


def _amount(seed: str, digits: int, scale: int) -> str:
    """A decimal whose size is spread over all magnitudes that it may have."""
    return f"CAST(round(exp({_hash(seed)} / 2147483648D * ln(pow(10D, {digits - scale - 1}))), {scale}) AS DECIMAL({digits},{scale}))"


def _share(seed: str) -> str:
    return f"({_hash(seed)} / 2147483648D)"


def _day(seed: str, days: int) -> str:
    return f"date_add(DATE '2020-02-29', CAST({_hash(seed)} % {days} AS INT))"


def _moment(seed: str) -> str:
    return f"timestamp_micros(1500000000000000 + {_hash(seed)} * 100003)"


def _yes(seed: str, percent: int) -> str:
    return f"{_hash(seed)} % 100 < {percent}"


@dataclass(frozen=True)
class Spec:
    schema_name: str
    table_name: str
    rows: int
    columns: dict[str, str]
    partition_by: list[str] = field(default_factory=list)
    external: bool = False


# Names and types of the columns are those of the tables that a copy is tried on; all values are made up here.
SPECS = [
    Spec("sales", "transactions_fact", 5_000_000, {
        "transaction_id": "concat('t', hex(id))", "customer_id": f"{_hash('cu')} % 300000", "product_sku": _code("sku", 8000),
        "quantity": f"CAST({_hash('q')} % 48 AS INT)", "unit_price": _amount("up", 12, 2), "total_amount": _amount("ta", 14, 2),
        "currency": _code("cur", 6), "channel": _code("ch", 5), "region": _code("reg", 7), "transaction_date": _day("td", 400),
        "created_at": _moment("ca"), "is_refunded": _yes("rf", 3),
    }, ["transaction_date", "region"]),
    Spec("sales", "customer_dim", 100_000, {
        "customer_id": "id * 3 + 1", "full_name": "concat_ws(' ', upper(left(md5(CAST(id AS STRING)), 3)), hex(id))", "email": "concat(md5(CAST(id AS STRING)), '@mail.invalid')",
        "phone": f"lpad(CAST({_hash('ph')} AS STRING), 12, '0')", "country_code": _code("co", 30), "loyalty_tier": _code("tier", 4),
        "signup_date": _day("su", 2500), "is_active": _yes("ac", 85),
    }),
    Spec("finance", "revenue_monthly", 120, {
        "month_key": "make_timestamp(2012 + CAST(id / 12 AS INT), CAST(id % 12 AS INT) + 1, 1, 0, 0, 0)", "total_revenue": _amount("tr", 16, 2),
        "total_orders": f"{_hash('to')} % 77777", "avg_order_value": _amount("ao", 10, 2), "region": _code("reg", 7),
    }),
    Spec("sales", "empty_staging_table", 0, {"batch_id": "hex(id)", "payload": "CAST(NULL AS STRING)", "loaded_at": _moment("la")}),
    Spec("analytics", "wide_schema_table", 10_000, {
        "id": "id", **{f"col_{i:03d}": f"exp(3 * {_share(f'w{i}')})" for i in range(1, 101)}, **{f"flag_{i:02d}": _yes(f"f{i}", 4 * i) for i in range(1, 21)},
    }),
    Spec("operations", "special-table_v2", 5_000, {"id": "id", "value": f"sqrt({_share('v')})"}),
    Spec("edge_cases", "single_row_table", 1, {"record_id": "'only'", "status": "'there'", "version": "id + 9"}),
    Spec("edge_cases", "complex_types_table", 2_000, {
        "id": "id", "attributes": f"map('shape', {_code('shape', 9)}, 'grade', {_code('grade', 3)})",
        "tags": f"slice(array('north', 'old', 'wet', 'blue', 'wide'), 1, CAST({_hash('tg')} % 6 AS INT))", "scores": f"transform(sequence(1, 4), k -> k * {_share('sc')})",
    }),
    Spec("analytics", "pageviews_hourly", 1_000_000, {
        "event_id": "sha1(CAST(id AS STRING))", "event_type": _code("ev", 6), "user_id": f"{_hash('us')} % 70000", "session_id": f"hex({_hash('se')} % 30000)",
        "page_url": f"concat('/', {_code('page', 900)})", "duration_ms": f"CAST(exp(11 * {_share('du')}) AS BIGINT)", "event_date": _day("ed", 200),
    }, ["event_date", "event_type"]),
    Spec("sales", "product_catalog", 50_000, {
        "sku": "concat('p', hex(id))", "product_name": "reverse(md5(CAST(id AS STRING)))", "category": _code("cat", 12), "unit_cost": _amount("uc", 10, 2),
        "is_available": _yes("av", 70), "supplier_code": _code("sup", 150),
    }, external=True),
    Spec("operations", "warehouse_locations", 2_400, {
        "warehouse_id": "id * 7", "warehouse_code": "concat('d', hex(id))", "city": _code("town", 400), "state": _code("st", 16), "country": _code("co", 30),
        "latitude": f"180 * {_share('lat')} - 90", "longitude": f"360 * {_share('lon')} - 180",
    }, external=True),
]


def generate(spark: SparkSession, spec: Spec, rows: int | None = None) -> DataFrame:
    """The table of a spec, with another number of rows if wished."""
    base = spark.range(spec.rows if rows is None else rows)
    return base.select(*[F.expr(expr).alias(name) for name, expr in spec.columns.items()])


def bulk_table(spark: SparkSession, schema_name: str, table_name: str, rows: int) -> DataFrame:
    """One of many small tables of the same form."""
    own = f"{schema_name}.{table_name}"
    columns = {
        "row_id": "id", "business_key": f"md5(concat('{own}', id))", "name": f"concat(hex(id), ' of {own}')", "category_id": f"CAST({_hash(own)} % 33 AS INT)",
        "amount": _amount(own, 12, 2), "is_active": _yes(own, 60), "load_date": _day(own, 90), "ingested_at": _moment(own),
    }
    return generate(spark, Spec(schema_name, table_name, rows, columns))


def write(spark: SparkSession, spec: Spec, root: str, rows: int | None = None) -> str:
    """Write a generated table below ``root`` and give its folder."""
    path = f"{root.rstrip('/')}/{spec.schema_name}/{spec.table_name}"
    generate(spark, spec, rows).write.mode("overwrite").partitionBy(*spec.partition_by).parquet(path)
    return path
