"""What a relational source is asked for: columns, masks, changed rows, and key ranges.

The statement is made from the contract and the source's own list of columns, so excluded columns never leave the source
and masked ones leave it masked.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..contracts import ContractError, TableContract

FETCH_SIZE = 20_000

# Types of the source and what they are stored as; any other type is stored as text.
STORED_TYPES = {
    "int": "bigint", "bigint": "bigint", "smallint": "bigint", "tinyint": "bigint",
    "bit": "boolean",
    "decimal": "decimal(38,9)", "numeric": "decimal(38,9)", "money": "decimal(38,9)", "smallmoney": "decimal(38,9)",
    "float": "double", "real": "double",
    "datetime": "timestamp", "datetime2": "timestamp", "smalldatetime": "timestamp", "datetimeoffset": "timestamp",
    "date": "date", "time": "string",
    "uniqueidentifier": "string",
}
# Types that are not stored at all.
LEFT_OUT = ("varbinary", "binary", "image", "geography", "geometry", "xml", "hierarchyid", "sql_variant")


@dataclass(frozen=True)
class SourceSelect:
    """The select list for a source, the stored type of each column in it, and what is left out and why."""

    text: str
    types: dict[str, str]
    dropped: dict[str, str]


def _quoted(column: str) -> str:
    return "[" + column.replace("]", "]]") + "]"


def _masked(column: str, mode: str) -> str:
    name = _quoted(column)
    if mode == "xxx":
        return f"CASE WHEN {name} IS NOT NULL THEN 'xxx' END"
    at = f"CHARINDEX('@', {name})"
    return f"CASE WHEN {at} > 0 THEN STUFF({name}, 1, {at} - 1, 'xxx') WHEN {name} IS NOT NULL THEN 'xxx' END"


def source_select(contract: TableContract, columns: Mapping[str, str]) -> SourceSelect:
    """The select list for the source's ``columns``, given with their types.

    A contract that names a column which the source does not have, or an unknown
    mask, stops the run: a typo must not let personal data through.
    """
    named = {"exclude": contract.exclude, "mask": contract.mask, "key": contract.key}
    for what, names in named.items():
        missing = sorted(set(names) - set(columns))
        if missing:
            raise ContractError(f"{contract.target}: {what} names columns that the source does not have: {', '.join(missing)}")
    unknown = sorted(set(contract.mask.values()) - {"xxx", "email_domain"})
    if unknown:
        raise ContractError(f"{contract.target}: unknown mask mode: {', '.join(unknown)}")
    parts, types, dropped = [], {}, {}
    for column, kind in columns.items():
        plain = kind.lower().partition("(")[0].strip()
        if column in contract.exclude:
            dropped[column] = "excluded"
        elif plain in LEFT_OUT:
            dropped[column] = f"type {plain} is not stored"
        elif column in contract.mask:
            parts.append(f"{_masked(column, contract.mask[column])} AS {_quoted(column)}")
            types[column] = "string"
        else:
            parts.append(_quoted(column))
            types[column] = STORED_TYPES.get(plain, "string")
    if not parts:
        raise ContractError(f"{contract.target}: no column of the source is stored")
    return SourceSelect(", ".join(parts), types, dropped)


def jdbc_options(
    contract: TableContract,
    url: str,
    *,
    mark: dt.datetime | None = None,
    bounds: tuple[int, int] | None = None,
    columns: list[str] | None = None,
    select: SourceSelect | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    The column list and the watermark bound go into the pushed sub-select, so the
    source never sends excluded columns or unchanged rows. With ``chunk_by`` and
    known key bounds the pull is split into windows of about ``chunk_size`` keys.
    ``select`` comes from :func:`source_select` and also fixes the types; a contract
    that excludes or masks columns is never pulled without a list of columns.
    """
    if select is None and columns is None and (contract.exclude or contract.mask):
        raise ContractError(f"{contract.target}: excludes or masks columns, so the pull needs a list of them")
    chosen = select.text if select else ", ".join(columns) if columns else "*"
    query = f"SELECT {chosen} FROM {contract.source}"
    if mark is not None and contract.watermark:
        query += f" WHERE {contract.watermark} >= '{mark:%Y-%m-%d %H:%M:%S}'"
    options = {"url": url, "dbtable": f"({query}) src", "fetchsize": str(FETCH_SIZE)}
    if select:
        options["customSchema"] = ", ".join(f"`{c.replace('`', '``')}` {kind}" for c, kind in select.types.items())
    if contract.chunk_by and bounds:
        low, high = bounds
        options |= {
            "partitionColumn": contract.chunk_by,
            "lowerBound": str(low),
            "upperBound": str(high + 1),
            "numPartitions": str(max(1, math.ceil((high - low + 1) / contract.chunk_size))),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
