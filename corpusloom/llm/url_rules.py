"""URL filtering by fixed host-and-path rules, and by rules that frequent patterns of URL tokens give for the rest."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

ALLOW, BLOCK = "allow", "block"
# Verdict items have a mark that no URL token begins with.
MARK = "="


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits the host or a parent of it and begins the path; null if none does."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        cut = rule.index("/")
        name, prefix = rule[:cut], rule[cut:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """At most eight tokens of a URL, one of a kind: scheme, top level, site, first label, first folder, ending, query, port.

    Numbers become ``0``. A fixed number of kinds bounds the combinations that can be frequent.
    """
    name = F.regexp_replace(host, r"^.*@|:\d*$", "")
    level = F.regexp_extract(name, r"([^.]+)$", 1)
    folder = F.regexp_replace(F.regexp_extract(path, r"^/+([^/]*)", 1), r"\d+", "0")
    kinds = {
        "scheme": F.lower(F.regexp_extract(url, r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        "tld": level,
        "site": F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1),
        "label": F.regexp_replace(F.regexp_extract(name, r"^([^.]+)\..*\.", 1), r"\d+", "0"),
        "folder": folder,
        "ending": F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)),
        "query": F.regexp_extract(url, r"\?([^=&#]*)", 1),
        "port": F.regexp_extract(host, r":(\d+)$", 1),
    }
    items = [F.when(v != "", F.concat(F.lit(f"{k}:"), v)) for k, v in kinds.items()]
    return F.array_compact(F.array(*items))


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8) -> list[tuple[tuple[str, ...], str, float, float]]:
    """Token combinations that foretell a verdict: (tokens, verdict, confidence, support), best first.

    ``labelled`` has ``tokens`` and ``verdict``; Spark's FP-growth counts over all rows. At most 2**8 combinations of a
    row's tokens each need a share of ``min_support``, so no more than 2**9 / ``min_support`` itemsets can come out,
    whatever the size of the table; only those that end in a verdict at ``min_confidence`` come to the driver. A rule is
    dropped if one with fewer of its tokens gives the same verdict at least as surely. Without labelled rows: no rules.
    """
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(MARK), F.col("verdict"))).alias("items"))
    if baskets.isEmpty():
        return []
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    verdicts = [MARK + ALLOW, MARK + BLOCK]
    ends = model.associationRules.where(F.col("consequent")[0].isin(verdicts)).select("antecedent", "consequent", "confidence", "support").collect()
    found = [(tuple(sorted(r[0])), r[1][0][len(MARK) :], r[2], r[3]) for r in ends]
    found.sort(key=lambda r: (len(r[0]), -r[2], -r[3], r[0]))
    kept: list[tuple[tuple[str, ...], str, float, float]] = []
    for rule in found:
        tokens = set(rule[0])
        if not any(k[1] == rule[1] and k[2] >= rule[2] and tokens.issuperset(k[0]) for k in kept):
            kept.append(rule)
    return sorted(kept, key=lambda r: (-r[2], -r[3], len(r[0]), r[0]))


def rule_verdict(tokens: Column, rules: list[tuple[tuple[str, ...], str, float, float]], default: str = ALLOW) -> Column:
    """Verdict of the best mined rule whose tokens a URL all has; ``default`` where none fits.

    Each rule stands under its rarest token (by how many rules have it), so a URL looks only at rules of its own tokens.
    """
    uses: dict[str, int] = defaultdict(int)
    for items, *_ in rules:
        for item in items:
            uses[item] += 1
    index: dict[str, list[tuple[int, frozenset, str]]] = defaultdict(list)
    for rank, (items, verdict, *_) in enumerate(rules):
        index[min(items, key=lambda i: (uses[i], i))].append((rank, frozenset(items), verdict))
    index = dict(index)

    @pandas_udf("string")
    def judge(column: pd.Series) -> pd.Series:
        def one(items) -> str:
            own = set(items)
            hits = [(rank, verdict) for i in own for rank, needed, verdict in index.get(i, ()) if needed <= own]
            return min(hits)[1] if hits else default

        return column.map(one)

    return judge(tokens)


def judge_urls(
    pages: DataFrame, rules: dict[str, str], min_support: float = 0.002, min_confidence: float = 0.8, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """Host, path, fitting rule and verdict of every URL.

    The longest fitting rule decides. The URLs it decides are the labels from which token rules are mined for the others;
    where no mined rule fits either, the verdict is allow. Null and odd URLs have an empty host and path; repeated rows are
    judged alike; ids may be null. Runs the mining while it is built. Columns: the id, ``host``, ``path``, ``rule``, ``verdict``.
    """
    url = F.col("_url")
    parts = pages.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_url"))
    parts = parts.select("_id", "_url", host_of(url).alias("host"), path_of(url).alias("path"))
    named = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    parts = parts.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    tokens = url_tokens(F.coalesce(url, F.lit("")), F.col("host"), F.col("path"))
    parts = parts.select("*", F.element_at(named, F.col("rule")).alias("given"), tokens.alias("tokens"))
    mined = mine_rules(parts.where(F.col("given").isNotNull()).select("tokens", F.col("given").alias("verdict")), min_support, min_confidence)
    verdict = F.coalesce(F.col("given"), rule_verdict(F.col("tokens"), mined))
    return parts.select(F.col("_id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"))
