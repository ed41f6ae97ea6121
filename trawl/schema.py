"""What a collection looks like: its columns, its metric and what it indexes.

A collection is a table of documents: an id, the text, a fixed-length vector, typed metadata
columns and one JSON metadata column for everything else.  ``CollectionSchema`` carries those
names, so that operators never guess them, and checks a DataFrame against them at plan time.
"""

from __future__ import annotations

import enum
import json
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.text import SPLIT_LOWER, VERBATIM, Analyzer

# SQL type names a metadata column may be declared with, and the Spark type of each.
SQL_TYPES = {
    "TEXT": "string",
    "VARCHAR": "string",
    "CHAR": "string",
    "CHARACTER": "string",
    "BPCHAR": "string",
    "STRING": "string",
    "UUID": "string",
    "JSON": "string",
    "INT": "int",
    "INTEGER": "int",
    "INT2": "smallint",
    "INT4": "int",
    "INT8": "bigint",
    "BIGINT": "bigint",
    "SMALLINT": "smallint",
    "TINYINT": "tinyint",
    "BOOL": "boolean",
    "BOOLEAN": "boolean",
    "REAL": "float",
    "FLOAT": "float",
    "FLOAT4": "float",
    "FLOAT8": "double",
    "DOUBLE": "double",
    "DATE": "date",
    "TIME": "string",
    "TIMETZ": "string",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMPTZ": "timestamp",
    "BYTEA": "binary",
    "BLOB": "binary",
    "HUGEINT": "decimal(38,0)",
}

# Declared types that cannot be part of the metadata index.
UNINDEXABLE_TYPES = {"NUMERIC", "DECIMAL", "HUGEINT", "UUID", "INTERVAL", "VARIANT"}


def base_type(sql_type: str) -> str:
    """``VARCHAR(50)`` -> ``VARCHAR``, ``double precision`` -> ``DOUBLE``."""
    words = sql_type.upper().replace("(", " ").split()
    return words[0] if words else ""


def spark_type(sql_type: str) -> T.DataType:
    """Spark type of a declared SQL type; unknown names are taken as Spark's own DDL."""
    base = base_type(sql_type)
    if base in ("DECIMAL", "NUMERIC"):
        args = sql_type[sql_type.index("("):] if "(" in sql_type else "(18,3)"
        return _from_ddl("decimal" + args)
    return _from_ddl(SQL_TYPES.get(base, sql_type))


def _from_ddl(ddl: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {ddl}")["c"].dataType


def is_indexable(sql_type: str | None) -> bool:
    """Whether the default metadata index takes a column of this type (unknown: yes)."""
    if sql_type is None:
        return True
    base = base_type(sql_type)
    return base in SQL_TYPES and base not in UNINDEXABLE_TYPES


class Metric(str, enum.Enum):
    """The four distances; smaller is always nearer."""

    L2 = "l2"
    COSINE = "cosine"
    IP = "ip"
    L1 = "l1"


@dataclass(frozen=True)
class Column:
    """Declaration of a metadata (or id) column."""

    name: str
    data_type: str
    nullable: bool = True

    def __post_init__(self) -> None:
        for what in ("name", "data_type"):
            if not isinstance(getattr(self, what), str):
                raise ValueError(f"Column {what} must be a string")

    @classmethod
    def of(cls, spec: "Column | dict[str, Any]") -> "Column":
        """Accept the dataclass or a dict holding all three keys."""
        if isinstance(spec, Column):
            return spec
        for key, kind in (("name", str), ("data_type", str), ("nullable", bool)):
            if not isinstance(spec.get(key), kind):
                raise TypeError(f"The '{key}' entry of a column must be a {kind.__name__}")
        return cls(spec["name"], spec["data_type"], spec["nullable"])


@dataclass(frozen=True)
class IndexedColumn:
    """A typed metadata column in the metadata index; ``analyzer`` makes it full text."""

    name: str
    analyzer: Analyzer | None = None


@dataclass(frozen=True)
class IndexedJsonField:
    """A JSON metadata field (key or dotted path) promoted to a typed physical column."""

    path: str
    data_type: str
    analyzer: Analyzer | None = None

    @property
    def is_text(self) -> bool:
        return self.data_type.strip().upper() == "TEXT"

    @property
    def physical(self) -> str:
        return "json__" + self.path.replace(".", "__")


@dataclass(frozen=True)
class MetadataIndex:
    """``columns=None`` means every eligible typed column; ``[]`` means none."""

    columns: tuple[IndexedColumn, ...] | None = None
    json_fields: tuple[IndexedJsonField, ...] = ()

    def __post_init__(self) -> None:
        if self.columns is not None:
            object.__setattr__(self, "columns", tuple(self.columns))
        object.__setattr__(self, "json_fields", tuple(self.json_fields))


@dataclass(frozen=True)
class CollectionSchema:
    """Names, types and search defaults of one collection."""

    dim: int | None = None
    id_column: str = "id"
    content_column: str = "content"
    embedding_column: str = "embedding"
    metadata_columns: dict[str, str | None] = field(default_factory=dict)
    json_column: str | None = "metadata"
    id_type: str = "UUID"
    not_null: frozenset[str] = frozenset()
    metric: Metric = Metric.COSINE
    k: int = 4
    fetch_k: int = 20
    lambda_mult: float = 0.5
    content_analyzer: Analyzer = SPLIT_LOWER
    metadata_index: MetadataIndex | None = None
    #: Metadata columns that documents are returned with; ``None`` means all.
    returned: tuple[str, ...] | None = None

    # -- declaring and opening ------------------------------------------------------------

    @classmethod
    def declare(
        cls,
        dim: int,
        *,
        metadata_columns: list[Column | dict[str, Any]] | None = None,
        id_column: str | Column | dict[str, Any] = "id",
        json_column: str = "metadata",
        store_metadata: bool = True,
        **options: Any,
    ) -> "CollectionSchema":
        columns = [Column.of(spec) for spec in metadata_columns or []]
        key = Column(id_column, "UUID") if isinstance(id_column, str) else Column.of(id_column)
        return cls(
            dim=int(dim),
            id_column=key.name,
            id_type=key.data_type,
            metadata_columns={c.name: c.data_type for c in columns},
            not_null=frozenset(c.name for c in columns if not c.nullable),
            json_column=json_column if store_metadata else None,
            **options,
        )

    @classmethod
    def inspect(
        cls,
        df: DataFrame,
        *,
        id_column: str = "id",
        content_column: str = "content",
        embedding_column: str = "embedding",
        metadata_columns: list[str] | None = None,
        ignore_metadata_columns: list[str] | None = None,
        json_column: str | None = "metadata",
        **options: Any,
    ) -> "CollectionSchema":
        """Validate an existing table against the requested names (ValueError on mismatch)."""
        if metadata_columns and ignore_metadata_columns:
            raise ValueError("metadata_columns and ignore_metadata_columns exclude each other")
        types = {f.name: f.dataType for f in df.schema.fields}
        if not types:
            raise ValueError("there is no column to read")
        missing = [c for c in (id_column, content_column, embedding_column) if c not in types]
        if missing:
            raise ValueError(f"no such column: {', '.join(missing)}")
        wanted = {content_column: (T.StringType, T.CharType, T.VarcharType),
                  embedding_column: T.ArrayType}
        for name, kind in wanted.items():
            if not isinstance(types[name], kind):
                raise ValueError(f"{name} is {types[name].simpleString()}, which cannot be used here")
        if json_column not in types:
            json_column = None
        chosen = list(metadata_columns or [])
        if ignore_metadata_columns:
            skip = {id_column, content_column, embedding_column, *ignore_metadata_columns}
            chosen = [c for c in df.columns if c not in skip and not c.startswith("json__")]
        unknown = [c for c in chosen if c not in types]
        if unknown:
            raise ValueError(f"no such metadata column: {', '.join(unknown)}")
        return cls(
            id_column=id_column,
            content_column=content_column,
            embedding_column=embedding_column,
            metadata_columns={c: types[c].simpleString() for c in chosen},
            json_column=json_column,
            **options,
        )

    def to_json(self) -> str:
        """The whole definition, as a collection keeps it."""
        spec = asdict(self)
        spec["not_null"], spec["metric"] = sorted(self.not_null), self.metric.value
        del spec["returned"]  # a reader's choice
        return json.dumps(spec)

    @classmethod
    def from_json(cls, text: str) -> "CollectionSchema":
        spec = json.loads(text)
        index = spec.pop("metadata_index")
        if index is not None:
            columns = index["columns"]
            index = MetadataIndex(
                None if columns is None else [
                    IndexedColumn(c["name"], _analyzer(c["analyzer"])) for c in columns],
                [IndexedJsonField(f["path"], f["data_type"], _analyzer(f["analyzer"]))
                 for f in index["json_fields"]])
        return cls(**{
            **spec, "not_null": frozenset(spec["not_null"]), "metric": Metric(spec["metric"]),
            "content_analyzer": _analyzer(spec["content_analyzer"]), "metadata_index": index})

    # -- derived names --------------------------------------------------------------------

    @property
    def shown(self) -> list[str]:
        """Metadata columns of a returned document, in declared order."""
        return [c for c in self.metadata_columns if self.returned is None or c in self.returned]

    @property
    def reserved(self) -> list[str]:
        names = [self.id_column, self.content_column, self.embedding_column]
        names += self.shown
        if self.json_column and self.json_column not in names:
            names.append(self.json_column)
        return names

    @property
    def distance_alias(self) -> str:
        """``distance``, or the first free ``distance_N`` when a column has that name."""
        taken, alias, n = set(self.reserved), "distance", 0
        while alias in taken:
            n += 1
            alias = f"distance_{n}"
        return alias

    def columns(self, embedding: bool = False) -> list[str]:
        names = self.reserved
        return names if embedding else [n for n in names if n != self.embedding_column]

    def struct(self) -> T.StructType:
        """The table's Spark schema, in declared order."""
        fields = [
            T.StructField(self.id_column, spark_type(self.id_type), False),
            T.StructField(self.content_column, T.StringType(), False),
            T.StructField(self.embedding_column, T.ArrayType(T.FloatType(), False), False),
        ]
        for name, sql_type in self.metadata_columns.items():
            kind = spark_type(sql_type or "string")
            fields.append(T.StructField(name, kind, name not in self.not_null))
        if self.json_column and self.json_column not in self.metadata_columns:
            fields.append(T.StructField(self.json_column, T.StringType()))
        return T.StructType(fields)

    def with_index(self, metadata_index: MetadataIndex | None) -> "CollectionSchema":
        out = replace(self, metadata_index=metadata_index)
        out.indexed_columns()
        return out

    # -- metadata index -------------------------------------------------------------------

    def indexed_columns(self) -> dict[str, Analyzer | None]:
        """Typed columns in the metadata index, each with its analyzer (None = verbatim)."""
        spec = self.metadata_index
        if spec is not None and spec.json_fields and not self.json_column:
            raise ValueError("promoted fields need a JSON metadata column")
        if spec is None or spec.columns is None:
            return {n: None for n, t in self.metadata_columns.items() if is_indexable(t)}
        for column in spec.columns:
            if column.name not in self.metadata_columns:
                raise ValueError(f"the metadata index names an unknown column: {column.name}")
            if not is_indexable(self.metadata_columns[column.name]):
                kind = self.metadata_columns[column.name]
                raise ValueError(f"the metadata index does not take {kind} columns: {column.name}")
        return {c.name: c.analyzer for c in spec.columns}

    def analyzed_fields(self) -> dict[str, Analyzer]:
        """Metadata columns and JSON text fields declared with an analyzer, which get postings."""
        index = self.metadata_index
        if index is None:
            return {}
        return ({c.name: c.analyzer for c in index.columns or () if c.analyzer}
                | {f.path: f.analyzer for f in index.json_fields if f.is_text and f.analyzer})

    def json_field(self, path: str) -> IndexedJsonField | None:
        fields = self.metadata_index.json_fields if self.metadata_index else ()
        return next((f for f in fields if f.path == path), None)

    def promote(self, df: DataFrame) -> DataFrame:
        """Add one typed physical column per indexed JSON field, so filters reach the scan."""
        if not self.metadata_index or not self.metadata_index.json_fields:
            return df
        if not self.json_column:
            raise ValueError("promoted fields need a JSON metadata column")
        return df.withColumns({
            f.physical: json_typed(F.col(self.json_column), f.path, f.data_type)
            for f in self.metadata_index.json_fields
        })


def _analyzer(spec: dict | None) -> Analyzer | None:
    return None if spec is None else Analyzer(**spec)


def json_text(column: SparkColumn, path: str) -> SparkColumn:
    """Text of a (dotted) path inside a JSON string column; JSON null and absent are NULL."""
    steps = "".join(f"['{part}']" for part in path.split("."))
    return F.get_json_object(column, "$" + steps)


def json_typed(column: SparkColumn, path: str, data_type: str) -> SparkColumn:
    text = json_text(column, path)
    if data_type.strip().upper() == "TEXT":
        return text
    return text.try_cast(spark_type(data_type))


__all__ = [
    "Analyzer", "CollectionSchema", "Column", "IndexedColumn", "IndexedJsonField",
    "MetadataIndex", "Metric", "VERBATIM", "base_type", "is_indexable", "json_text",
    "json_typed", "spark_type",
]
