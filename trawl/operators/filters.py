"""The nested-dict filter language, compiled to one boolean Column.

The Column is made of native expressions only, so predicates on typed (and promoted JSON)
columns reach the Parquet scan.  SQL's three-valued logic is kept: a missing value satisfies
no comparison, and its negation is unknown as well.
"""

from __future__ import annotations

import datetime as dt
import operator as op
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import text as tx
from trawl.functions.text import VERBATIM, Analyzer
from trawl.operators.fieldterms import FieldTerms
from trawl.schema import CollectionSchema, json_text, json_typed

COMPARISONS = {
    "$eq": op.eq, "$ne": op.ne, "$lt": op.lt, "$lte": op.le, "$gt": op.gt, "$gte": op.ge,
}
TERM_OPERATORS = {"$startswith", "$regex", "$fuzzy", "$match", "$ngram", "$phrase"}
LOGICAL = {"$and", "$or", "$not"}
FIELD_OPERATORS = (
    set(COMPARISONS) | TERM_OPERATORS | {"$in", "$nin", "$between", "$exists", "$like", "$ilike"}
)
SUPPORTED = FIELD_OPERATORS | LOGICAL

# The type a JSON text is read as, chosen by the exact type of the filter value.
VALUE_TYPES = {
    int: "bigint",
    float: "double",
    str: "string",
    bool: "boolean",
    dt.date: "date",
    dt.datetime: "timestamp_ntz",
    dt.time: "time",
}

DEFAULT_NGRAM_THRESHOLD = 0.7


def compile_filter(spec: dict[str, Any], schema: CollectionSchema) -> Column | None:
    """Boolean Column of a filter dict; ``None`` for the empty filter."""
    if not isinstance(spec, dict):
        raise ValueError(f"A filter must be a dict, got {type(spec)}")
    return _tree(spec, schema) if spec else None


#: Members of ``$in`` and ``$nin`` that stay in the plan; longer lists are joined, broadcast up to the
#: second number.
MAX_LISTED, MAX_BROADCAST_MEMBERS = 1_000, 1_000_000


def apply_filter(df: DataFrame, spec: dict | None, schema: CollectionSchema,
                 terms: dict[str, FieldTerms] | None = None) -> DataFrame:
    """The rows of ``df`` the filter holds for.

    ``terms`` names fields with an index of their terms (``FieldTerms`` over the ids of ``df``): term
    predicates on them are looked up there, and no row is analyzed. Long lists are joined as tables.
    """
    if not spec:
        return df
    joins = Joins(df, schema, terms or {})
    predicate = _tree(spec, schema, joins)
    for table, condition in joins.tables:
        df = df.join(table, condition, "left")
    return df.where(predicate).select(*joins.columns)


class Joins:
    """Tables that predicates of one filter are answered by, each joined once to every row."""

    def __init__(self, df: DataFrame, schema: CollectionSchema, terms: dict[str, FieldTerms]):
        self.spark, self.schema, self.terms = df.sparkSession, schema, terms
        self.columns = [F.col(f"`{c}`") for c in df.columns]
        self.tables: list[tuple[DataFrame, Column]] = []
        self.mark = "__filter"
        while any(c.startswith(self.mark) for c in df.columns):
            self.mark += "_"

    def _holds(self, table: DataFrame, key: Column, subject: Column) -> Column:
        """Whether the row's key is in the one column of a table; unknown where ``subject`` is null."""
        name = f"{self.mark}{len(self.tables)}"
        self.tables.append((table.toDF(name), key == F.col(name)))
        return F.when(subject.isNotNull(), F.col(name).isNotNull())

    def member(self, column: Column, members: list) -> Column:
        if any(isinstance(m, float) for m in members):
            kind, members = "double", [float(m) for m in members]
        else:
            kind = "string" if any(isinstance(m, str) for m in members) else "bigint"
        rows = [(str(m) if kind == "string" else m,) for m in dict.fromkeys(members)]
        table = self.spark.createDataFrame(rows, f"member {kind}")
        return self._holds(F.broadcast(table) if len(rows) <= MAX_BROADCAST_MEMBERS else table, column, column)

    def term(self, name: str, operator: str, value: Any, column: Column) -> Column | None:
        index = self.terms.get(name)
        if index is None:
            return None
        found = index.ids(operator, term_argument(operator, value, _field_analyzer(name, self.schema)))
        return None if found is None else self._holds(found, F.col(f"`{self.schema.id_column}`"), column)


def _tree(spec: Any, schema: CollectionSchema, joins: Joins | None = None) -> Column:
    if not isinstance(spec, dict):
        raise ValueError(f"A filter must be a dict, got {type(spec)}")
    if not spec:
        raise ValueError("An empty filter is only allowed at the top level")
    if len(spec) > 1:
        for key in spec:
            if isinstance(key, str) and key.startswith("$"):
                raise ValueError(f"Expected only fields beside each other, got: {key}")
        return reduce(op.and_, (_field(name, want, schema, joins) for name, want in spec.items()))
    (key, body), = spec.items()
    if not (isinstance(key, str) and key.startswith("$")):
        return _field(key, body, schema, joins)
    logic = key.lower()
    if logic not in LOGICAL:
        raise ValueError(f"Expected $and, $or or $not, got: {key}")
    if logic == "$not":
        if isinstance(body, dict):
            return ~_tree(body, schema, joins)
        if not isinstance(body, list) or not body:
            raise ValueError(f"$not takes a dict or a non-empty list, got {body!r}")
        return reduce(op.and_, (~_tree(part, schema, joins) for part in body))
    if not isinstance(body, list) or not body:
        raise ValueError(f"{key} takes a non-empty list, got {body!r}")
    return reduce(op.and_ if logic == "$and" else op.or_, (_tree(p, schema, joins) for p in body))


def _field(name: Any, body: Any, schema: CollectionSchema, joins: Joins | None = None) -> Column:
    if not isinstance(name, str):
        raise ValueError(f"A field name must be a string, got {name!r}")
    if name.startswith("$"):
        raise ValueError(f"Expected a field, got the operator {name}")
    if not all(part.isidentifier() for part in name.split(".")):
        raise ValueError(f"{name!r} cannot name a field")
    operator, value = "$eq", body
    if isinstance(body, dict):
        if len(body) != 1:
            raise ValueError(
                f"{name}: write one operator per field and combine fields, not {sorted(body)[:3]}"
            )
        (operator, value), = body.items()
        if operator not in SUPPORTED:
            raise ValueError(f"Invalid operator: {operator}. Use one of {sorted(SUPPORTED)}")
    column = _resolve(name, operator, value, schema)
    if operator in COMPARISONS:
        return _compare(column, operator, value)
    if operator == "$between":
        low, high = value
        return _compare(column, "$gte", low) & _compare(column, "$lte", high)
    if operator in ("$in", "$nin"):
        members = list(value)
        for member in members:
            if isinstance(member, bool) or not isinstance(member, (str, int, float)):
                raise NotImplementedError(f"Unsupported {operator} member: {member!r}")
        if not members:
            return F.lit(operator == "$nin")
        long = joins is not None and len(members) > MAX_LISTED
        hit = joins.member(column, members) if long else column.isin(members)
        return hit if operator == "$in" else ~hit
    if operator == "$like":
        return column.like(value)
    if operator == "$ilike":
        return column.ilike(value)
    if operator == "$exists":
        if not isinstance(value, bool):
            raise ValueError(f"$exists takes a bool, got {value!r}")
        return column.isNotNull() if value else column.isNull()
    if operator in TERM_OPERATORS:
        hit = joins.term(name, operator, value, column) if joins else None
        return _term_predicate(name, operator, value, column, schema) if hit is None else hit
    raise NotImplementedError(f"{operator} cannot be applied to a field")


def _resolve(name: str, operator: str, value: Any, schema: CollectionSchema) -> Column:
    """The Column a field name stands for (typed column, or a cast JSON path)."""
    head, _, rest = name.partition(".")
    own = {schema.id_column, schema.content_column, schema.embedding_column}
    in_json = (
        schema.json_column is not None
        and head not in schema.metadata_columns
        and head not in own
    )
    if in_json:
        declared = schema.json_field(name)
        if declared is not None:
            return F.col(declared.physical)
        text = json_text(F.col(schema.json_column), name)
    elif rest:
        text = json_text(F.col(head), rest)
    else:
        return F.col(f"`{name}`")
    sample = value[0] if isinstance(value, (list, tuple)) and value else value
    wanted = VALUE_TYPES.get(type(sample))
    if wanted is None:
        raise ValueError(f"Unsupported type: {type(sample)}")
    if wanted == "string" or operator == "$exists":
        return text
    if wanted == "time":
        return _clock(text)
    return text.try_cast(wanted)


def _clock(text: Column) -> Column:
    """Time of day as a timestamp on a fixed day, which orders and compares the same way."""
    return F.concat(F.lit("1970-01-01 "), text.cast("string")).try_cast("timestamp_ntz")


def _literal(value: Any) -> Column:
    if isinstance(value, dt.time):
        return F.lit(dt.datetime.combine(dt.date(1970, 1, 1), value)).cast("timestamp_ntz")
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def _compare(column: Column, operator: str, value: Any) -> Column:
    return COMPARISONS[operator](column, _literal(value))


# -- full-text terms ---------------------------------------------------------------------


def _field_analyzer(name: str, schema: CollectionSchema) -> Analyzer:
    """Analyzer of an indexed text field; ValueError when the field is not indexed."""
    head = name.split(".")[0]
    declared = schema.json_field(name)
    if declared is not None:
        if declared.is_text:
            return declared.analyzer or VERBATIM
    elif head in schema.metadata_columns:
        spec = schema.metadata_index
        if spec is None or spec.columns is None:
            return VERBATIM
        for column in spec.columns:
            if column.name == head:
                return column.analyzer or VERBATIM
    raise ValueError(
        f"{name} has no terms to match: declare it in the metadata index, as a column or a "
        "TEXT field"
    )


def term_argument(operator: str, value: Any, analyzer: Analyzer) -> Any:
    """The checked argument of a term operator, texts taken to pieces by the field's analyzer."""
    if operator == "$match":
        return _match_argument(value)
    if operator == "$ngram":
        wanted, threshold = _ngram_argument(value)
        return analyzer.terms(wanted), threshold
    if operator == "$phrase":
        segments, gaps, slop = _phrase_argument(value)
        return [analyzer.terms(s) for s in segments], gaps, slop
    return value


def _term_predicate(name, operator, value, column, schema) -> Column:
    analyzer = _field_analyzer(name, schema)
    terms = analyzer.tokens(column.cast("string"))
    argument = term_argument(operator, value, analyzer)
    if operator == "$startswith":
        return tx.any_startswith(terms, argument)
    if operator == "$regex":
        return tx.any_regex(terms, argument)
    if operator == "$fuzzy":
        return tx.any_fuzzy(terms, argument)
    if operator == "$match":
        return tx.match_any(terms, *argument)
    if operator == "$ngram":
        grams, threshold = argument
        return tx.ngram_similarity(terms, grams) >= F.lit(threshold)
    return tx.phrase(terms, *argument)


def _is_int(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _match_argument(value: Any) -> tuple[list[str], int | None]:
    words, least = value, None
    if isinstance(value, dict):
        words, least = value.get("tokens"), value.get("min_match")
    if not isinstance(words, (list, tuple)) or not words:
        raise ValueError("$match takes a non-empty list, or {'tokens': [...], 'min_match': N}")
    if least is not None and (not _is_int(least) or least <= 0):
        raise ValueError("$match min_match must be a positive integer")
    return list(words), least


def _ngram_argument(value: Any) -> tuple[str, float]:
    wanted, threshold = value, None
    if isinstance(value, dict):
        wanted, threshold = value.get("text"), value.get("threshold")
    if not isinstance(wanted, str) or not wanted:
        raise ValueError("$ngram takes a string, or {'text': str, 'threshold': number}")
    if threshold is None:
        return wanted, DEFAULT_NGRAM_THRESHOLD
    if isinstance(threshold, bool) or not isinstance(threshold, (int, float)):
        raise ValueError("$ngram threshold must be a number in [0, 1]")
    return wanted, float(threshold)


def _phrase_argument(value: Any):
    """Split a phrase spec into its text segments, the gaps between them, and the slop."""
    spec, slop = value, None
    if isinstance(value, dict):
        spec, slop = value.get("text"), value.get("slop")
    parts = [spec] if isinstance(spec, str) else spec
    if not isinstance(parts, (list, tuple)) or len(parts) % 2 == 0:
        raise ValueError("$phrase takes a string or an odd-length [segment, gap, segment, ...]")
    segments, gaps = list(parts[0::2]), []
    if not all(isinstance(s, str) and s for s in segments):
        raise ValueError("every part of a $phrase beside the gaps is a text with something in it")
    for gap in parts[1::2]:
        bounds = (gap, gap) if _is_int(gap) else gap
        if (
            not isinstance(bounds, (list, tuple))
            or len(bounds) != 2
            or not all(_is_int(b) for b in bounds)
        ):
            raise ValueError("$phrase gaps must be an int or a [min, max] pair of ints")
        if not 0 <= bounds[0] <= bounds[1]:
            raise ValueError("$phrase gaps need 0 <= min <= max")
        gaps.append(gap if _is_int(gap) else tuple(gap))
    if slop is not None:
        if not _is_int(slop) or slop < 0:
            raise ValueError("$phrase slop must be a non-negative integer")
        if any(isinstance(g, tuple) for g in gaps):
            raise ValueError("$phrase slop cannot go with an interval gap")
    return segments, gaps, slop


__all__ = ["apply_filter", "compile_filter", "json_typed", "term_argument"]
