"""Joins between transactions, customers, branches, the ZIP crosswalk and map features.

No join here forces a broadcast of data without a size bound: Spark broadcasts below
its own threshold and otherwise shuffles, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import first_area_code, zip_join_key
from ledgerloom.sources.writers import land

def with_customers(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions with their customer's SSN and names, matched on the card."""
    holders = customers.select("CREDIT_CARD_NO", "SSN", "FIRST_NAME", "LAST_NAME")
    return transactions.join(holders, "CREDIT_CARD_NO")


def with_customers_and_branches(transactions: DataFrame, customers: DataFrame, branches: DataFrame) -> DataFrame:
    """Transactions with customer names and the branch's ZIP."""
    zips = branches.select("BRANCH_CODE", "BRANCH_ZIP")
    return with_customers(transactions.join(zips, "BRANCH_CODE"), customers)


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def repeated_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that do not identify a row, with their number of rows: to be looked at before snapshots are compared."""
    return df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("num_records")).filter("num_records > 1")


def changed_values(
    before: DataFrame, after: DataFrame, key: str | list[str], column: str, keep: list[str], null_safe: bool = False
) -> DataFrame:
    """Rows of a table whose ``column`` differs between two snapshots of it.

    The columns of ``key`` should identify a row. The rows are joined as they are: where a key repeats, every
    old row meets every new one, so no change is lost and none is made up from two rows. A value that
    appears or disappears is a change only with ``null_safe``.
    """
    keys = _keys(key)
    old = before.select(*keys, *[c for c in keep if c not in keys], F.col(column).alias("original_value"))
    new = after.select(*keys, F.col(column).alias("updated_value"))
    was, now = F.col("original_value"), F.col("updated_value")
    return old.join(new, keys).filter(~was.eqNullSafe(now) if null_safe else was != now)


def patch_column(original: DataFrame, updated: DataFrame, key: str | list[str], column: str) -> DataFrame:
    """``original`` with ``column`` replaced where ``updated`` has a value for the key.

    A plain left join, so AQE can split a key with very many original rows. A key with several patches gives a
    row for each: none is dropped in silence, and ``repeated_keys`` tells of it.
    """
    names = {k: f"__patch_{i}" for i, k in enumerate(_keys(key))}
    patch = updated.select(*[F.col(k).alias(n) for k, n in names.items()], F.col(column).alias("__patch"))
    on = [F.col(k) == F.col(n) for k, n in names.items()]
    return original.join(patch, on, "left").withColumn(column, F.coalesce("__patch", column)).select(original.columns)


CROSSWALK_COLUMNS = ["CUST_CITY", "CUST_STATE", "CUST_COUNTY", "AREA_CODE"]
# Of the copies of a row, one and the rest modulo 8 come singly, all others in blocks of 8, 64 and 512.
BLOCK_COPIES = (1, 8, 64, 512)
ROWS_A_TASK = 5_000_000


def _different_crosswalk_rows(crosswalk: DataFrame) -> DataFrame:
    """``__zip``, the crosswalk's columns as ``right_...``, and the number of ``copies`` of each different row; ZIPs that match only.

    Grouped inside a struct, so that a join shuffles the table anew and AQE may split a ZIP with very many customers.
    """
    key = zip_join_key(F.col("CUST_ZIP")).alias("__zip")
    row = F.struct(key, *[F.col(c).alias(f"right_{c}") for c in CROSSWALK_COLUMNS])
    rows = crosswalk.select(row.alias("__row")).filter("__row.__zip is not null")
    return rows.groupBy("__row").agg(F.count(F.lit(1)).alias("copies")).select("__row.*", "copies")


def _join_on_zip(customers: DataFrame, per_zip: DataFrame, how: str = "left") -> DataFrame:
    left = customers.withColumn("__left_zip", zip_join_key(F.col("CUST_ZIP")))
    return left.join(per_zip, F.col("__left_zip") == F.col("__zip"), how).drop("__left_zip", "__zip")


def with_crosswalk_rows(customers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Customers with every crosswalk row of their ZIP; unmatched customers are kept.

    A ZIP listed several times repeats the customer, so the result grows with the product of both tables: what needs only
    counts or the smallest row asks ``with_match_counts`` or ``with_first_crosswalk_row``. Equal crosswalk rows are
    joined once for each block of ``BLOCK_COPIES``, and the finished rows of a block are repeated by a product with as many rows without columns:
    Spark copies them as they are there, where an explode would build every row of its columns anew. Both tables are written first, since each
    size of block reads them, and customers are dealt over as many tasks as the rows of that size need.
    The load job does not use this form: see ``with_area_code``.
    """
    customers = land(customers, "crosswalk-customers")
    blocks = land(_blocks_of_copies(_different_crosswalk_rows(crosswalk)), "crosswalk-rows")
    totals = _rows_by_block(customers, blocks)
    products = [_in_blocks(customers, blocks, size, totals.get(size, 0)) for size in BLOCK_COPIES if size == 1 or size in totals]
    return reduce(DataFrame.unionByName, products)


def _blocks_of_copies(different: DataFrame) -> DataFrame:
    """Each different crosswalk row once for every block of ``__copies`` that its number of copies takes, a single one among them."""
    wanted = [F.array(F.lit(1))]
    for size, above in zip(BLOCK_COPIES, (*BLOCK_COPIES[1:], None)):
        blocks = F.expr(f"(copies - 1) div {size}")
        wanted.append(F.array_repeat(F.lit(size), (blocks % (above // size) if above else blocks).cast("int")))
    return different.select("*", F.explode(F.concat(*wanted)).alias("__copies")).drop("copies")


def _rows_by_block(customers: DataFrame, blocks: DataFrame) -> dict[int, int]:
    """How many rows of customers and crosswalk come in blocks of each size that occurs."""
    counts = blocks.groupBy(F.struct("__zip", "__copies").alias("__group")).agg(F.sum("__copies").alias("__rows"))
    key = zip_join_key(F.col("CUST_ZIP"))
    holders = customers.groupBy(F.struct(key.alias("__zip")).alias("__holder")).agg(F.count(F.lit(1)).alias("__holders"))
    met = holders.join(counts, F.col("__holder.__zip") == F.col("__group.__zip"))
    return dict(met.groupBy("__group.__copies").agg(F.sum(F.col("__holders") * F.col("__rows"))).collect())


def _in_blocks(customers: DataFrame, blocks: DataFrame, size: int, total: int) -> DataFrame:
    """The rows that come in blocks of one size; customers without a crosswalk row come with the single ones."""
    dealt = customers.repartition(-(-total // ROWS_A_TASK)) if total > ROWS_A_TASK else customers
    if size > 1:
        again = customers.sparkSession.range(0, size, 1, 1).select().hint("shuffle_replicate_nl")
        return _join_on_zip(dealt, blocks.filter(F.col("__copies") == size).drop("__copies"), "inner").crossJoin(again)
    return _join_on_zip(dealt, blocks.filter(F.col("__copies") == size).drop("__copies"))


def with_match_counts(customers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Customers with the number of rows ``with_crosswalk_rows`` has for them, ``matches``, and of different ones, ``different_matches``."""
    zips = _different_crosswalk_rows(crosswalk).groupBy(F.struct("__zip").alias("__group"))
    counts = zips.agg(F.sum("copies").alias("matches"), F.count(F.lit(1)).alias("different_matches"))
    one = F.lit(1).cast("long")
    joined = _join_on_zip(customers, counts.select("__group.__zip", "matches", "different_matches"))
    return joined.withColumns({c: F.coalesce(F.col(c), one) for c in ("matches", "different_matches")})


def with_first_crosswalk_row(customers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Of the rows of ``with_crosswalk_rows`` the smallest for each customer, in column order, nulls first."""
    right = [f"right_{c}" for c in CROSSWALK_COLUMNS]
    zips = _different_crosswalk_rows(crosswalk).groupBy(F.struct("__zip").alias("__group"))
    first = zips.agg(F.min(F.struct(*right)).alias("__right")).select("__group.__zip", "__right.*")
    return _join_on_zip(customers, first)


def area_code_by_zip(crosswalk: DataFrame) -> DataFrame:
    """One area code for each ZIP, whatever its form: the first of its lists in text order.

    Grouped inside a struct, so that a join shuffles the table anew and AQE may split a ZIP with very many customers.
    """
    return (
        crosswalk.select(F.struct(zip_join_key(F.col("CUST_ZIP")).alias("__zip")).alias("__group"), "AREA_CODE")
        .filter("__group.__zip is not null")
        .groupBy("__group")
        .agg(first_area_code(F.min("AREA_CODE")).alias("AREA_CODE"))
        .select("__group.__zip", "AREA_CODE")
    )


def with_area_code(customers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Customers with the area code of their ZIP, one row each; Spark broadcasts the codes if they are few."""
    return _join_on_zip(customers, area_code_by_zip(crosswalk))


def features_with_counts(features: DataFrame, counts: DataFrame, name: str, value: str) -> DataFrame:
    """Every map feature with the value of its name; features without one get null."""
    return features.join(counts.select(name, value), name, "left")
