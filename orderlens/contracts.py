"""What is promised about a replicated table."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

DEFAULT_MAX_AGE_DAYS = 2
DEFAULT_CHUNK_SIZE = 500_000
GRANULARITIES = ("DAY", "MONTH", "YEAR")


class ContractError(ValueError):
    """A table or its declaration does not match the contract."""


@dataclass(frozen=True)
class TableContract:
    target: str
    source: str = ""
    key: tuple[str, ...] = ()
    watermark: str | None = None
    partition_by: str | None = None
    granularity: str = "DAY"
    cluster_by: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    mask: dict[str, str] = field(default_factory=dict)
    full_reload: bool = False
    max_age_days: int = DEFAULT_MAX_AGE_DAYS
    chunk_by: str | None = None
    chunk_size: int = DEFAULT_CHUNK_SIZE
    charset: str | None = None

    def __post_init__(self) -> None:
        if self.granularity.upper() not in GRANULARITIES:
            raise ContractError(f"{self.target}: granularity must be one of {GRANULARITIES}")

    @classmethod
    def from_entry(cls, entry: dict, key: Iterable[str] = ()) -> "TableContract":
        """Contract from one entry of a JSON registry file.

        Field names are those of the registry format; the primary key is not in
        it, because it is discovered from the source catalog.
        """
        source = ".".join(entry[k] for k in ("db", "schema", "table") if entry.get(k))
        return cls(
            target=entry["target"],
            source=source,
            key=tuple(key),
            watermark=entry.get("watermark"),
            partition_by=entry.get("partition_by"),
            granularity=entry.get("partition_granularity") or "DAY",
            cluster_by=tuple(entry.get("cluster_by") or ()),
            exclude=tuple(entry.get("exclude") or ()),
            mask=dict(entry.get("mask") or {}),
            full_reload=bool(entry.get("pelny_reload")),
            max_age_days=int(entry.get("prog_wieku_dni", DEFAULT_MAX_AGE_DAYS)),
            chunk_by=entry.get("chunk_by"),
            chunk_size=int(entry.get("chunk_size") or DEFAULT_CHUNK_SIZE),
            charset=entry.get("charset"),
        )

    def check(self, df: DataFrame) -> None:
        """Every declared column must exist, or the run stops before it writes."""
        named = [*self.key, *self.cluster_by, *self.mask, *self.exclude]
        named += [c for c in (self.watermark, self.partition_by, self.chunk_by) if c]
        missing = sorted(set(named) - set(df.columns))
        if missing:
            raise ContractError(f"{self.target}: no such column: {', '.join(missing)}")


def load_registry(text: str, keys: dict[str, Iterable[str]] | None = None) -> list[TableContract]:
    """Contracts from the JSON text of a registry with a ``tables`` list."""
    keys = keys or {}
    return [TableContract.from_entry(e, keys.get(e["target"], ())) for e in json.loads(text)["tables"]]


REGISTRY_SCHEMA = "target string, source string, watermark string, max_age_days int"


def registry_frame(spark: SparkSession, contracts: Iterable[TableContract]) -> DataFrame:
    """The contracts as a table, one row per declared target."""
    rows = [(c.target, c.source, c.watermark, c.max_age_days) for c in contracts]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)
