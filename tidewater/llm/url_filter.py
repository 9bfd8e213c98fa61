"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression with the literal tokens that any URL it fits must contain. The rule is filed under
the one of its tokens that the fewest URLs of the corpus have. A URL's own tokens then fetch its candidate rules, and
only those run their regular expressions, so the work a URL costs does not grow with the number of rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; ``pattern`` is searched in ``host + path``; any URL it fits has all ``tokens`` among the
    [a-z0-9]+ runs of its lower-cased host and path. Rules of a higher ``rank`` win, then the earlier one."""
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def prefix_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``. Longer rules rank higher.

    A URL may go on where the rule ends (``/en/1`` fits ``/en/17``), so a last token of the path is no literal one."""
    host = host.lower()
    tokens = TOKEN.findall(host) + [t.lower() for t in re.findall("[A-Za-z0-9]+(?=[^A-Za-z0-9])", path)]
    return Rule(host + path, verdict, rf"\A(?:[^/]*\.)?{re.escape(host)}(?=/|\Z){re.escape(path)}",
                tuple(dict.fromkeys(tokens)), 1_000_000 + len(host) + len(path))


def pattern_rule(name: str, pattern: str, tokens: Iterable[str], verdict: str = "block") -> Rule:
    """A rule of the method's own: a regular expression over host and path. Ranks below every prefix rule."""
    return Rule(name, verdict, pattern, tuple(tokens), 0)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://`` or for a null."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A(?>.*?://)[^/?#]*(/[^?#]*)", 1), F.lit(""))


def token_counts(urls: DataFrame, tokens: Iterable[str]) -> dict[str, int]:
    """How many URLs have each of the rules' tokens; counted over all rows, one row per token of the rules."""
    wanted = sorted(set(tokens))
    found = (urls.select(F.explode(F.array_distinct(F.split(F.lower(F.concat("host", "path")),
                                                            "[^a-z0-9]+"))).alias("token"))
             .where(F.col("token").isin(wanted)).groupBy("token").count())
    return {**dict.fromkeys(wanted, 0), **{r["token"]: r["count"] for r in found.collect()}}


def rule_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """token -> rules filed under it; and the rules without any literal token, which every URL has to run."""
    index: dict[str, list[int]] = {}
    loose: list[int] = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            loose.append(i)
    return index, loose


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", block_rules: int = 50_000) -> DataFrame:
    """Judge every row: its id, ``host``, ``path``, ``rule`` (name of the winning rule, else null), ``verdict`` (the
    rule's, else ``default``) and ``n_candidates`` (regular expressions run).

    Null URLs and those without ``://`` have empty host and path, fit no rule and get the default. Repeated rows are
    each judged. An empty table or rule list is fine; other columns are not read. The rules travel with the tasks in
    blocks of ``block_rules``; more rules than that take one narrow pass per block, the best so far carried along.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    counts = token_counts(rows, (t for r in rules for t in r.tokens)) if rules else {}
    out = rows.select("id", "host", "path", F.lit(None).cast("string").alias("rule"),
                      F.lit(None).cast("string").alias("verdict"), F.lit(0).alias("n_candidates"))
    ranked = sorted(rules, key=lambda r: -r.rank)
    for first in range(0, len(ranked), block_rules):
        out = out.mapInArrow(_judge(ranked[first:first + block_rules], counts), out.schema)
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("verdict", F.lit(default)).alias("verdict"), "n_candidates")


def _judge(rules: list[Rule], counts: dict[str, int]):
    index, loose = rule_index(rules, counts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[int, re.Pattern] = {}
        for batch in batches:
            cols = batch.to_pydict()
            for k, (host, path, verdict) in enumerate(zip(cols["host"], cols["path"], cols["verdict"], strict=True)):
                if not host or verdict is not None:  # no host, or a block of higher rank has decided
                    continue
                where = host + path
                candidates = sorted({i for t in set(TOKEN.findall(where.lower())) for i in index.get(t, ())}
                                    .union(loose))
                cols["n_candidates"][k] += len(candidates)
                for i in candidates:  # best rank first
                    if i not in compiled:
                        compiled[i] = re.compile(rules[i].pattern)
                    if compiled[i].search(where):
                        cols["rule"][k], cols["verdict"][k] = rules[i].name, rules[i].verdict
                        break
            yield pa.RecordBatch.from_pydict(cols, schema=batch.schema)

    return judge
