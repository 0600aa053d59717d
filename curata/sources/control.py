"""Control tables: one row per ingested table, column mappings.

Control tables are small by nature (one row per table or per column); the
functions that fetch a row or a mapping to the driver are bounded by that,
never by the data being loaded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def _match(df: DataFrame, keys: dict) -> DataFrame:
    cond = F.lit(True)
    for k, v in keys.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.where(cond)


def lookup(ctl: DataFrame, schema: str, table: str, schema_col: str = "schema_name",
           table_col: str = "table_name") -> DataFrame:
    """Control rows of one (schema, table)."""
    return _match(ctl, {schema_col: schema, table_col: table})


def control_row(ctl: DataFrame, schema: str, table: str, **kw) -> Row:
    """The single control row of a table; an error when there is none."""
    rows = lookup(ctl, schema, table, **kw).take(2)
    if not rows:
        raise LookupError(f"no control row for {schema}.{table}")
    return rows[0]


def worklist(ctl: DataFrame, product: str | None = None, product_col: str = "data_product_name",
             enabled_col: str = "is_table_enabled", order_col: str = "table_name") -> DataFrame:
    """Enabled tables (of one data product), ordered by name."""
    df = ctl.where(F.upper(F.col(enabled_col)) == "TRUE")
    if product is not None:
        df = df.where(F.col(product_col) == product)
    return df.orderBy(order_col)


def cell(ctl: DataFrame, value_col: str, **keys) -> DataFrame:
    """A configuration cell selected by one or several key columns."""
    return _match(ctl, keys).select(value_col)


# ------------------------------------------------------------- column mapping
def mapping_rows(mapping: DataFrame, table: str, table_col: str = "table_name",
                 order_col: str = "target_col_order") -> list[Row]:
    """Mapping rows of one table in target order (one row per column)."""
    return mapping.where(F.col(table_col) == table).orderBy(order_col).collect()


def projection_exprs(rows: Sequence[Row], source_col: str = "source_col_name",
                     target_col: str = "target_col_name", expr_col: str = "target_col_expression") -> list[str]:
    """``coalesce(expression, source col) AS target`` per mapping row."""
    out = []
    for r in rows:
        expr = r[expr_col] if expr_col in r.asDict() and r[expr_col] else f"`{r[source_col]}`"
        out.append(f"{expr} AS `{r[target_col]}`")
    return out


def mapped_projection(df: DataFrame, mapping: DataFrame, table: str, **kw) -> DataFrame:
    return df.selectExpr(*projection_exprs(mapping_rows(mapping, table), **kw))


def rename_map(rows: Sequence[Row], source_col: str = "source_col_name",
               target_col: str = "target_col_name") -> dict[str, str]:
    return {r[source_col]: r[target_col] for r in rows}


def merge_lists(rows: Sequence[Row], target_col: str = "target_col_name",
                key_order_col: str = "target_key_col_order") -> tuple[list[str], list[str], list[str]]:
    """(key columns, update columns, insert columns) from mapping rows: key
    columns have a key order; every mapped column is inserted; non-key
    columns are updated."""
    keyed = sorted([r for r in rows if r[key_order_col] is not None], key=lambda r: r[key_order_col])
    keys = [r[target_col] for r in keyed]
    insert = [r[target_col] for r in rows]
    update = [c for c in insert if c not in keys]
    return keys, update, insert
