"""The filter language on typed columns, on JSON paths and on analyzed terms."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from trawl.functions.text import VERBATIM, Analyzer
from trawl.operators.fieldterms import FieldTerms
from trawl.operators.filters import TERM_OPERATORS, apply_filter
from trawl.operators.layout import cluster
from trawl.plans.common import SQL_TOKENS, table
from trawl.schema import CollectionSchema, IndexedColumn, IndexedJsonField, MetadataIndex
from trawl.session import scratch_path
from trawl.sources.storage import Folder

EVENTS = CollectionSchema(
    id_column="event_id", json_column="props",
    metadata_columns={"ts": "TIMESTAMP", "user_id": "BIGINT", "event_type": "TEXT", "value": "DOUBLE"},
)
PROMOTED = EVENTS.with_index(MetadataIndex(json_fields=[IndexedJsonField("k", "INTEGER")]))
PARTS = CollectionSchema(
    id_column="p_partkey", json_column=None,
    metadata_columns={"p_name": "TEXT", "p_brand": "TEXT", "p_type": "TEXT", "p_size": "INT"},
)
WORDS = PARTS.with_index(MetadataIndex(columns=[
    IndexedColumn("p_name", Analyzer("split")), IndexedColumn("p_type"),
]))
GRAMS = PARTS.with_index(MetadataIndex(columns=[IndexedColumn("p_name", Analyzer("ngram"))]))
PROSE = CollectionSchema(
    id_column="doc_id", json_column=None,
    metadata_columns={"text": "TEXT", "lang": "TEXT", "source": "TEXT", "n_chars": "BIGINT"},
).with_index(MetadataIndex(columns=[IndexedColumn("text", Analyzer("split"))]))

NOON = dt.datetime(2024, 1, 15, 12, 0, 0)

# name: (table, schema, filter, SQL predicate)
CASES = {
    "typed_eq": ("events", EVENTS, {"event_type": "click"}, "event_type = 'click'"),
    "typed_ne": ("events", EVENTS, {"event_type": {"$ne": "click"}}, "event_type <> 'click'"),
    "typed_lt": ("events", EVENTS, {"value": {"$lt": 10.5}}, "value < 10.5"),
    "typed_lte": ("events", EVENTS, {"value": {"$lte": 10.5}}, "value <= 10.5"),
    "typed_gt": ("events", EVENTS, {"ts": {"$gt": NOON}}, "ts > TIMESTAMP '2024-01-15 12:00:00'"),
    "typed_gte": ("events", EVENTS, {"user_id": {"$gte": 100}}, "user_id >= 100"),
    "typed_between": ("events", EVENTS, {"value": {"$between": [5, 20.25]}}, "value BETWEEN 5 AND 20.25"),
    "typed_in": ("events", EVENTS, {"event_type": {"$in": ["view", "signup"]}}, "event_type IN ('view', 'signup')"),
    "typed_nin": ("events", EVENTS, {"user_id": {"$nin": [1, 2, 3]}}, "user_id NOT IN (1, 2, 3)"),
    "typed_in_empty": ("events", EVENTS, {"event_type": {"$in": []}}, "1 = 0"),
    "typed_nin_empty": ("events", EVENTS, {"event_type": {"$nin": []}}, "1 = 1"),
    "typed_like": ("part", PARTS, {"p_name": {"$like": "%bolt"}}, "p_name LIKE '%bolt'"),
    "typed_ilike": ("part", PARTS, {"p_name": {"$ilike": "SMALL%"}}, "p_name ILIKE 'SMALL%'"),
    "typed_exists": ("events", EVENTS, {"value": {"$exists": True}}, "value IS NOT NULL"),
    "json_eq": ("events", EVENTS, {"k": 42}, "TRY_CAST(props->>'k' AS BIGINT) = 42"),
    "json_eq_text": ("events", EVENTS, {"k": "42"}, "(props->>'k') = '42'"),
    "json_ne": ("events", EVENTS, {"k": {"$ne": 42}}, "TRY_CAST(props->>'k' AS BIGINT) <> 42"),
    "json_lt": ("events", EVENTS, {"k": {"$lt": 9}}, "TRY_CAST(props->>'k' AS BIGINT) < 9"),
    "json_lte": ("events", EVENTS, {"k": {"$lte": 9}}, "TRY_CAST(props->>'k' AS BIGINT) <= 9"),
    "json_gt": ("events", EVENTS, {"k": {"$gt": 90.5}}, "TRY_CAST(props->>'k' AS DOUBLE) > 90.5"),
    "json_gte": ("events", EVENTS, {"k": {"$gte": 90.5}}, "TRY_CAST(props->>'k' AS DOUBLE) >= 90.5"),
    "json_between": ("events", EVENTS, {"k": {"$between": [10, 19]}}, "TRY_CAST(props->>'k' AS BIGINT) BETWEEN 10 AND 19"),
    "json_in": ("events", EVENTS, {"k": {"$in": [7, 70]}}, "TRY_CAST(props->>'k' AS BIGINT) IN (7, 70)"),
    "json_nin": ("events", EVENTS, {"k": {"$nin": [7, 70]}}, "TRY_CAST(props->>'k' AS BIGINT) NOT IN (7, 70)"),
    "json_like": ("events", EVENTS, {"k": {"$like": "1%"}}, "(props->>'k') LIKE '1%'"),
    "json_ilike": ("events", EVENTS, {"k": {"$ilike": "%1"}}, "(props->>'k') ILIKE '%1'"),
    "json_exists": ("events", EVENTS, {"k": {"$exists": True}}, "(props->>'k') IS NOT NULL"),
    "json_absent": ("events", EVENTS, {"nothing": {"$exists": False}}, "(props->>'nothing') IS NULL"),
    "json_absent_ne": ("events", EVENTS, {"nothing": {"$ne": 1}}, "TRY_CAST(props->>'nothing' AS BIGINT) <> 1"),
    "json_path": ("events", EVENTS, {"props.k": {"$gte": 50}}, "TRY_CAST(props->'props'->>'k' AS BIGINT) >= 50"),
    "json_promoted": ("events", PROMOTED, {"k": {"$between": [20, 40]}}, "TRY_CAST(props->>'k' AS INTEGER) BETWEEN 20 AND 40"),
    "and": ("events", EVENTS, {"$and": [{"event_type": "view"}, {"k": {"$lt": 30}}, {"value": {"$gt": 1}}]},
            "event_type = 'view' AND TRY_CAST(props->>'k' AS BIGINT) < 30 AND value > 1"),
    "or": ("events", EVENTS, {"$or": [{"event_type": "error"}, {"k": 3}]},
           "event_type = 'error' OR TRY_CAST(props->>'k' AS BIGINT) = 3"),
    "not": ("events", EVENTS, {"$not": {"$or": [{"event_type": "error"}, {"k": {"$lt": 50}}]}},
            "NOT (event_type = 'error' OR TRY_CAST(props->>'k' AS BIGINT) < 50)"),
    "nor": ("events", EVENTS, {"$NOT": [{"event_type": "error"}, {"nothing": 1}]},
            "NOT (event_type = 'error') AND NOT (TRY_CAST(props->>'nothing' AS BIGINT) = 1)"),
    "implicit_and": ("events", EVENTS, {"event_type": "purchase", "k": {"$gte": 50}, "user_id": {"$lt": 100}},
                     "event_type = 'purchase' AND TRY_CAST(props->>'k' AS BIGINT) >= 50 AND user_id < 100"),
    "fts_startswith": ("part", WORDS, {"p_name": {"$startswith": "wid"}},
                       "len(list_filter(string_split(p_name, ' '), lambda t: starts_with(t, 'wid'))) > 0"),
    "fts_startswith_verbatim": ("part", WORDS, {"p_type": {"$startswith": "S"}}, "starts_with(p_type, 'S')"),
    "fts_regex": ("part", WORDS, {"p_name": {"$regex": "g[aei].*r"}},
                  "len(list_filter(string_split(p_name, ' '), lambda t: regexp_full_match(t, 'g[aei].*r'))) > 0"),
    "fts_fuzzy": ("part", WORDS, {"p_name": {"$fuzzy": "wigdet"}},
                  "len(list_filter(string_split(p_name, ' '), lambda t: levenshtein(t, 'wigdet') <= 2)) > 0"),
    "fts_fuzzy_verbatim": ("part", PARTS, {"p_brand": {"$fuzzy": "Brand#1"}}, "levenshtein(p_brand, 'Brand#1') <= 2"),
    "fts_match": ("part", WORDS, {"p_name": {"$match": ["bolt", "ring"]}},
                  "list_has_any(string_split(p_name, ' '), ['bolt', 'ring'])"),
    "fts_match_n": ("part", WORDS, {"p_name": {"$match": {"tokens": ["small", "red", "bolt"], "min_match": 2}}},
                    "len(list_intersect(string_split(p_name, ' '), ['small', 'red', 'bolt'])) >= 2"),
    "fts_ngram": ("part", GRAMS, {"p_name": {"$ngram": {"text": "smell rink", "threshold": 0.4}}},
                  "len(list_intersect(list_transform(range(1, len(p_name)), lambda i: substr(p_name, i::BIGINT, 2)),"
                  " ['sm', 'me', 'el', 'll', 'l ', ' r', 'ri', 'in', 'nk'])) / 9.0 >= 0.4"),
    "fts_and_or": ("part", WORDS, {"$or": [{"p_name": {"$match": ["gear"]}}, {"$and": [
                       {"p_type": "PROMO"}, {"$not": {"p_name": {"$phrase": "small bolt"}}}]}]},
                   "list_contains(string_split(p_name, ' '), 'gear') OR (p_type = 'PROMO' AND NOT (p_name = 'small bolt'))"),
    "fts_phrase_verbatim": ("part", PARTS, {"p_name": {"$phrase": "red widget"}}, "p_name = 'red widget'"),
}

_OCC = f"""
t AS (SELECT doc_id, {SQL_TOKENS} AS toks FROM documents),
w AS (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos FROM t)"""


def _sql_phrase(words, conditions) -> str:
    joins = " ".join(
        f"JOIN w w{i} ON w{i}.doc_id = w0.doc_id AND w{i}.term = '{word}'"
        for i, word in enumerate(words) if i
    )
    return (f"WITH {_OCC} SELECT DISTINCT w0.doc_id FROM w w0 {joins} "
            f"WHERE w0.term = '{words[0]}' AND {conditions}")


PHRASES = {
    "fts_phrase": ({"text": {"$phrase": "in the"}}, _sql_phrase(["in", "the"], "w1.pos = w0.pos + 1")),
    "fts_phrase_gap": ({"text": {"$phrase": ["the", 2, "of"]}},
                       _sql_phrase(["the", "of"], "w1.pos = w0.pos + 3")),
    "fts_phrase_interval": ({"text": {"$phrase": ["the", [1, 4], "of", 0, "the"]}},
                            _sql_phrase(["the", "of", "the"],
                                        "w1.pos - w0.pos BETWEEN 2 AND 5 AND w2.pos = w1.pos + 1")),
    "fts_phrase_slop": ({"text": {"$phrase": {"text": "the of in", "slop": 3}}},
                        _sql_phrase(["the", "of", "in"],
                                    "w1.pos > w0.pos AND w2.pos > w1.pos AND "
                                    "abs(w1.pos - w0.pos - 1) + abs(w2.pos - w1.pos - 1) <= 3")),
    "fts_phrase_gap_slop": ({"text": {"$phrase": {"text": ["the", 2, "of"], "slop": 1}}},
                            _sql_phrase(["the", "of"], "abs(w1.pos - w0.pos - 3) <= 1")),
    "fts_match_text": ({"text": {"$match": {"tokens": ["the", "und", "les"], "min_match": 2}}},
                       f"WITH {_OCC} SELECT doc_id FROM w WHERE term IN ('the', 'und', 'les') "
                       "GROUP BY doc_id HAVING count(DISTINCT term) >= 2"),
}

QUERIES: dict = {}
ORACLES: dict = {}


def _filtered(name, schema, spec):
    def run(spark, sf):
        rows = schema.promote(table(spark, sf, name))
        return apply_filter(rows, spec, schema).select(schema.id_column)
    return run


for _case, (_table, _schema, _spec, _sql) in CASES.items():
    _key = f"filter_{_case}" if not _case.startswith("fts_") else _case
    QUERIES[_key] = _filtered(_table, _schema, _spec)
    ORACLES[_key] = f"SELECT {_schema.id_column} FROM {_table} WHERE {_sql}"

for _case, (_spec, _sql) in PHRASES.items():
    QUERIES[_case] = _filtered("documents", PROSE, _spec)
    ORACLES[_case] = _sql


def filter_nested_path(spark, sf):
    """A dotted path inside JSON built from two columns of the documents."""
    docs = table(spark, sf, "documents").select(
        "doc_id", F.to_json(F.struct(F.struct("lang", "n_chars").alias("attrs"), "source")).alias("metadata"))
    schema = CollectionSchema(id_column="doc_id")
    spec = {"attrs.lang": "en", "attrs.n_chars": {"$gte": 2000}, "source": {"$like": "src1%"}}
    return apply_filter(docs, spec, schema).select("doc_id")


QUERIES["filter_nested_path"] = filter_nested_path
ORACLES["filter_nested_path"] = (
    "SELECT doc_id FROM documents WHERE lang = 'en' AND n_chars >= 2000 AND source LIKE 'src1%'"
)


def filter_typed_json_path(spark, sf):
    """A dotted path inside a typed JSON column, beside the open JSON column."""
    events = table(spark, sf, "events").withColumn("metadata", F.lit("{}"))
    schema = CollectionSchema(id_column="event_id", metadata_columns={"props": "JSON"})
    return apply_filter(events, {"props.k": {"$lt": 25}}, schema).select("event_id")


QUERIES["filter_typed_json_path"] = filter_typed_json_path
ORACLES["filter_typed_json_path"] = (
    "SELECT event_id FROM events WHERE TRY_CAST(props->>'k' AS BIGINT) < 25"
)


# -- terms by an index --------------------------------------------------------------------

_TERMS: dict[tuple, FieldTerms] = {}


def field_terms(spark, sf, name, schema, field) -> FieldTerms:
    """The index of one field's terms, built once per application and then read."""
    analyzer = next((c.analyzer or VERBATIM for c in schema.metadata_index.columns or () if c.name == field), VERBATIM) \
        if schema.metadata_index else VERBATIM
    key = (spark.sparkContext.applicationId, sf, name, field, analyzer)
    if key not in _TERMS:
        path = scratch_path(spark, f"terms-{uuid.uuid4().hex}")
        built = FieldTerms.build(table(spark, sf, name), schema.id_column, F.col(field), analyzer, buckets=8)
        _TERMS[key] = built.write(Folder(spark, path))
    return _TERMS[key]


def _fields_of(spec) -> set[str]:
    """Fields of a filter that have a term predicate."""
    if isinstance(spec, list):
        return set().union(*map(_fields_of, spec))
    found = set()
    for key, body in spec.items():
        if key.startswith("$"):
            found |= _fields_of(body)
        elif isinstance(body, dict) and next(iter(body)) in TERM_OPERATORS:
            found.add(key)
    return found


def _indexed(name, schema, spec):
    def run(spark, sf):
        terms = {f: field_terms(spark, sf, name, schema, f) for f in sorted(_fields_of(spec))}
        return apply_filter(table(spark, sf, name), spec, schema, terms).select(schema.id_column)
    return run


_TERM_CASES = {k: v for k, v in CASES.items() if k.startswith("fts_")} | {
    k: ("documents", PROSE, spec, None) for k, (spec, _) in PHRASES.items()}
for _case, (_table, _schema, _spec, _) in _TERM_CASES.items():
    QUERIES[f"{_case}_indexed"] = _indexed(_table, _schema, _spec)
    ORACLES[f"{_case}_indexed"] = ORACLES[_case]

# -- long lists, and fields that only some rows have ---------------------------------------

LONG_LIST = list(range(0, 60_000, 3))


def _sparse_events(spark, sf):
    """Events of which some have no user, and some no ``big`` in their JSON."""
    events = table(spark, sf, "events")
    big = F.when(F.col("value") > 50, F.round("value", 2))
    return events.select("event_id", F.expr("nullif(user_id, 5)").alias("user_id"), "event_type",
                         F.to_json(F.struct(big.alias("big"), "event_type")).alias("metadata"))


SPARSE = CollectionSchema(id_column="event_id", metadata_columns={"user_id": "BIGINT", "event_type": "TEXT"})
_SPARSE_SQL = "(SELECT event_id, nullif(user_id, 5) AS user_id, event_type, value > 50 AS big FROM events)"
for _case, _spec, _sql in (
    ("typed_in_long", {"user_id": {"$in": LONG_LIST}}, "user_id % 3 = 0 AND user_id BETWEEN 0 AND 59999"),
    ("typed_nin_long", {"user_id": {"$nin": LONG_LIST}}, "NOT (user_id % 3 = 0 AND user_id BETWEEN 0 AND 59999)"),
    ("in_long_logic", {"$or": [{"$not": {"user_id": {"$in": LONG_LIST}}}, {"event_type": "click"}]},
     "NOT (user_id % 3 = 0 AND user_id BETWEEN 0 AND 59999) OR event_type = 'click'"),
    ("typed_exists_some", {"user_id": {"$exists": True}}, "user_id IS NOT NULL"),
    ("typed_absent_some", {"user_id": {"$exists": False}}, "user_id IS NULL"),
    ("json_exists_some", {"big": {"$exists": True}}, "big"),
    ("json_absent_some", {"big": {"$exists": False}}, "big IS NULL OR NOT big"),
    ("nor_some", {"$not": [{"event_type": "click"}, {"user_id": {"$lt": 40}}]},
     "NOT (event_type = 'click') AND NOT (user_id < 40)"),
):
    QUERIES[f"filter_{_case}"] = lambda spark, sf, spec=_spec: apply_filter(
        _sparse_events(spark, sf), spec, SPARSE).select("event_id")
    ORACLES[f"filter_{_case}"] = f"SELECT event_id FROM {_SPARSE_SQL} WHERE {_sql}"


# -- rows along a curve --------------------------------------------------------------------

def filter_clustered(spark, sf):
    """A filter on the second and the third of the columns that the rows were laid out by."""
    rows = table(spark, sf, "events").withColumn("user_id", F.expr("nullif(user_id, 5)"))
    store = Folder(spark, scratch_path(spark, f"clustered-{uuid.uuid4().hex}"))
    laid = store.save("rows", cluster(rows, ["ts", "user_id", "value", "event_type"], "event_id"))
    spec = {"user_id": {"$between": [20, 60]}, "value": {"$gt": 40.0}, "event_type": {"$ne": "error"}}
    return apply_filter(laid, spec, EVENTS).select("event_id", "user_id")


QUERIES["filter_clustered"] = filter_clustered
ORACLES["filter_clustered"] = (
    "SELECT event_id, user_id FROM (SELECT event_id, nullif(user_id, 5) AS user_id, value, event_type FROM events) "
    "WHERE user_id BETWEEN 20 AND 60 AND value > 40 AND event_type <> 'error'"
)
