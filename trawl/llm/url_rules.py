"""URL verdicts by pattern rules that are found through their rarest literal token.

Every rule has literal tokens that any URL it matches must hold as whole tokens. A rule is filed
under the one of them that the fewest URLs of the table hold. The tokens of a URL then fetch the
few rules it could match, and only those run their regular expression. All of it is DataFrame
expressions: the index is a literal, so judging is one pass over the table without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ascii_lower

#: Rules held by one literal index; longer lists become several indexes, tried one after another.
RULES_PER_INDEX = 1000


@dataclass(frozen=True)
class UrlRule:
    """A regular expression over the lower-cased host followed by the path.

    ``tokens``: runs of a-z and 0-9 that every match holds as whole, lower-cased tokens. ``named``
    rules carry a host and path and the longest of them decides; the others are the general
    patterns, of which any allowing one outweighs all blocking ones.
    """

    name: str
    action: str
    regex: str
    tokens: tuple[str, ...]
    named: bool = False

    def __post_init__(self):
        if self.action not in ("allow", "block") or not self.tokens:
            raise ValueError(f"rule {self.name!r} needs an action and at least one literal token")


def _runs(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def host_rule(action: str, name: str) -> UrlRule:
    """``host/path``: the host with all its subdomains, and the paths that start with ``/path``."""
    host, slash, path = name.partition("/")
    if not slash:
        raise ValueError(f"{name!r} has no path; a whole host is written {name + '/'!r}")
    # The last run of the path may go on in a URL, as in /en against /english.
    certain = _runs(host) + (_runs(path) if not path[-1:].isalnum() else _runs(path)[:-1])
    return UrlRule(name, action, r"^(?:[^/]*\.)?" + re.escape(host.lower()) + re.escape(slash + path),
                   tuple(dict.fromkeys(certain)), named=True)


def glob_rule(action: str, glob: str) -> UrlRule:
    """``*`` stands for any characters; the pattern covers the whole of host and path."""
    parts = glob.lower().split("*")
    tokens = []
    for i, part in enumerate(parts):
        for m in re.finditer("[a-z0-9]+", part):
            open_left = m.start() == 0 and i > 0
            open_right = m.end() == len(part) and i < len(parts) - 1
            if not (open_left or open_right):
                tokens.append(m.group())
    return UrlRule(glob, action, r"(?is)^" + ".*".join(map(re.escape, parts)) + r"\z",
                   tuple(dict.fromkeys(tokens)))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(target), F.lit("[a-z0-9]+"), F.lit(0)))


def token_frequencies(urls: DataFrame, column: str, rules: Sequence[UrlRule]) -> dict[str, int]:
    """Rows of ``urls`` that hold each literal token of the rules; as many entries as tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    url = F.col(column)
    found = (urls.select(_tokens(F.concat(url_host(url), url_path(url))).alias("tokens"))
             .select(F.array_intersect("tokens", F.array(*map(F.lit, wanted))).alias("tokens"))
             .select(F.explode("tokens").alias("token")).groupBy("token").count())
    counts = dict.fromkeys(wanted, 0)
    counts.update({r["token"]: r["count"] for r in found.collect()})
    return counts


def _index(rules: Sequence[UrlRule], frequency: dict[str, int]) -> tuple[Column, int]:
    """Buckets of rules by the hash of their rarest token, as an array literal."""
    size = 1 << max(1, (2 * len(rules) - 1).bit_length())
    buckets: list[list[Column]] = [[] for _ in range(size)]
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (frequency[t], -len(t), t))
        entry = {"token": key, "name": rule.name, "action": rule.action, "regex": rule.regex,
                 "named": rule.named}
        buckets[zlib.crc32(key.encode()) % size].append(
            F.struct(*(F.lit(v).alias(k) for k, v in entry.items())))
    empty = F.array().cast("array<struct<token:string,name:string,action:string,regex:string,named:boolean>>")
    return F.array(*(F.array(*b) if b else empty for b in buckets)), size


def _lookup(index: Column, size: int):
    return lambda token: F.element_at(index, (F.crc32(token.cast("binary")) % size + 1).cast("int"))


def judge_urls(urls: DataFrame, rules: Sequence[UrlRule], column: str = "url",
               frequency: dict[str, int] | None = None) -> DataFrame:
    """Adds ``host, path, rule, pattern, verdict`` to every row of ``urls``.

    ``rule`` is the longest fitting host rule and decides; without one, ``pattern`` is the general
    rule that decided, and no match allows. A null URL or one without ``://`` has empty host and
    path. Repeated rows are judged alike, an empty table stays empty, and input columns of the
    added names are replaced.
    """
    urls = urls.drop("host", "path", "rule", "pattern", "verdict") if column not in (
        "host", "path", "rule", "pattern", "verdict") else urls
    if frequency is None:
        frequency = token_frequencies(urls, column, rules)
    # Working columns under names that the table does not have.
    mark = "__url"
    while any(c.lower().startswith(mark) for c in urls.columns):
        mark += "_"
    own = {name: f"{mark}_{name}" for name in ("host", "path", "target", "tokens", "hits", "named", "general")}
    work = urls.withColumns({own["host"]: url_host(F.col(column)), own["path"]: url_path(F.col(column))})
    work = work.withColumn(own["target"], F.concat(own["host"], own["path"])).withColumn(own["tokens"], _tokens(F.col(own["target"])))
    hits = []
    for start in range(0, len(rules), RULES_PER_INDEX):
        index, size = _index(rules[start:start + RULES_PER_INDEX], frequency)
        fetched = F.flatten(F.transform(own["tokens"], _lookup(index, size)))
        hits.append(F.filter(fetched, lambda r: F.array_contains(own["tokens"], r["token"])
                             & F.regexp_like(F.col(own["target"]), r["regex"])))
    work = work.withColumn(own["hits"], F.flatten(F.array(*hits)))
    # The longest host rule, and the first pattern by name with allowing ones before blocking ones.
    named = F.array_max(F.transform(F.filter(own["hits"], lambda r: r["named"]), lambda r: F.struct(
        F.length(r["name"]).alias("n"), r["name"].alias("name"), r["action"].alias("action"))))
    general = F.array_min(F.transform(F.filter(own["hits"], lambda r: ~r["named"]), lambda r: F.struct(
        r["action"].alias("action"), r["name"].alias("name"))))
    work = work.withColumns({own["named"]: named, own["general"]: general})
    return work.select(
        *[F.col(f"`{c}`") for c in urls.columns],
        F.col(own["host"]).alias("host"), F.col(own["path"]).alias("path"),
        F.col(own["named"] + ".name").alias("rule"),
        F.when(F.col(own["named"]).isNull(), F.col(own["general"] + ".name")).alias("pattern"),
        F.coalesce(own["named"] + ".action", own["general"] + ".action", F.lit("allow")).alias("verdict"))
