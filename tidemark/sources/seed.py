"""Literal product rows a new installation starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import PRODUCTS

# The start-up product list.
_SEED_PRODUCTS = """
    ('PROD-101', 'Multivitamins', 15.16, 10.61, '2024-02-21'),
    ('PROD-102', 'Vitamin C', 91.59, 64.11, '2024-10-11'),
    ('PROD-103', 'Vitamin D3', 64.46, 45.12, '2024-08-03'),
    ('PROD-104', 'Omega-3', 29.64, 20.75, '2024-08-13'),
    ('PROD-105', 'Probiotics', 17.19, 12.03, '2024-08-25'),
    ('PROD-106', 'Vitamin B12', 91.59, 64.11, '2024-01-24'),
    ('PROD-107', 'Magnesium', 11.28, 7.90, '2024-01-22'),
    ('PROD-108', 'Zinc', 23.74, 16.62, '2024-08-02'),
    ('PROD-109', 'Collagen', 20.14, 14.10, '2024-04-02'),
    ('PROD-110', 'Protein', 37.04, 25.93, '2024-11-15')
"""


def seed_products(spark: SparkSession) -> DataFrame:
    rows = spark.sql(
        "SELECT id AS product_id, name AS product_name, price, cost AS cost_price, "
        "day AS created_at, day AS updated_at "
        f"FROM VALUES {_SEED_PRODUCTS} AS seed(id, name, price, cost, day)"
    )
    return rows.select(*(rows[f.name].cast(f.dataType).alias(f.name) for f in PRODUCTS.schema))
