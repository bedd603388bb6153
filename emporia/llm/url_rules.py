"""URL filter by association rules (operator 12).

Written rules come first: a rule (host, path, verdict) fits a URL whose host is the rule's or below
it and whose path starts with the rule's; the longest fitting rule decides.  The URLs that they
decide are the labels from which verdicts for the others are learned: Spark's FP-growth mines
combinations of URL tokens together with the label, and rules ``tokens -> label`` of enough support
and confidence are kept, less those that a shorter rule makes needless.  A URL without a written
rule gets the label of its best mined rule, found by an inverted index, or the default.

Bound of what is broadcast: a URL has one token for each of the eight roles below, so it counts for
at most 2^9 combinations (label included); a combination that ``min_support`` of the labelled rows
share can stand ``2^9 / min_support`` times at most, however large the table (51,200 rules at 0.01
before pruning, eight 8-byte token digests each: 4 MB).  Tokens are handled as digests, so a very
long URL makes no large rule.  Mining works on rows counted by combination of tokens inside Spark's
parallel FP-growth; no shuffle carries URLs, and the verdict of a page is one narrow pass.

Defined cases: a null URL or one without ``://`` has an empty host and path, no tokens and the
default verdict; without labelled rows nothing is mined and the default holds.  Repeated rows count
as often as they stand; every row of the input is returned once.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from collections.abc import Iterable
from itertools import combinations

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import LOWER, UPPER

ALLOW, BLOCK = "allow", "block"
#: Written rules: (host, path, verdict). Fixed values of the query's contract.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
ROLES = ("tld", "site", "sub", "dir", "shape", "ext", "keys", "fragment")


# ---- parts of a URL -----------------------------------------------------------
def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    after = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def written_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule (as host + path) and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # a later, longer one stands before it
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column, url: Column) -> Column:
    """One token for each role that the URL has: all parts of it take part, long ones whole."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.regexp_replace(query, r"=[^&]*", "")
    shape = F.regexp_replace(path, r"[0-9]+", "0")
    first = F.regexp_extract(path, r"^/+([^/]+)/", 1)
    ext = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    parts = {
        "tld": F.element_at(labels, -1), "site": F.when(n > 1, F.concat_ws(".", F.slice(labels, F.greatest(n - 1, F.lit(1)), 2))),
        "sub": F.when(n > 2, F.get(labels, F.lit(0))), "dir": first, "shape": shape, "ext": ext, "keys": keys,
        "fragment": F.when(F.instr(url, "#") > 0, F.lit("#")),
    }
    named = [F.when(F.length(parts[r]) > 0, F.concat(F.lit(f"{r}:"), parts[r])) for r in ROLES]
    return F.when(host != "", F.filter(F.array(*named), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


# ---- mining ---------------------------------------------------------------------
def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Association rules (antecedent: token digests, label, confidence, support) from rows (tokens, label)."""
    baskets = labelled.where(F.col("label").isNotNull()).select(
        F.concat(F.transform("tokens", lambda t: F.hex(F.xxhash64(t))), F.array(F.concat(F.lit("="), "label"))).alias("items"))
    schema = "antecedent array<string>, label string, confidence double, support double"
    if baskets.isEmpty():
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    said = F.get("consequent", F.lit(0))
    found = model.associationRules.where(F.startswith(said, F.lit("=")))
    return found.select("antecedent", F.substr(said, F.lit(2)).alias("label"), "confidence", "support")


class Index:
    """Inverted index over the kept rules: each is listed under its rarest token."""

    def __init__(self, rules: Iterable[tuple[Iterable[str], str, float, float]]):
        best: dict[frozenset, tuple[str, float, float]] = {}
        for antecedent, label, confidence, support in rules:
            a, rule = frozenset(antecedent), (label, confidence, support)
            if a not in best or (-confidence, -support, label) < (-best[a][1], -best[a][2], best[a][0]):
                best[a] = rule
        kept = {a: r for a, r in best.items() if not self._needless(a, r, best)}
        # Best first: by confidence, support, fewer tokens, then label (rules still equal say the same).
        self.rules = [(a, *kept[a]) for a in sorted(kept, key=lambda a: (-kept[a][1], -kept[a][2], len(a), kept[a][0], sorted(a)))]
        often: dict[str, int] = defaultdict(int)
        for a, *_ in self.rules:
            for t in a:
                often[t] += 1
        self.lists: dict[str, list[int]] = defaultdict(list)
        for i, (a, *_) in enumerate(self.rules):
            self.lists[min(a, key=lambda t: (often[t], t))].append(i)

    @staticmethod
    def _needless(a: frozenset, rule: tuple, best: dict) -> bool:
        """A rule with fewer tokens says the same as surely (it fires wherever this one does)."""
        for k in range(1, len(a)):
            for part in combinations(a, k):
                other = best.get(frozenset(part))
                if other and other[0] == rule[0] and other[1] >= rule[1]:
                    return True
        return False

    def judge(self, items: frozenset) -> str | None:
        hits = [next((i for i in self.lists.get(t, ()) if self.rules[i][0] <= items), None) for t in items]
        first = min((i for i in hits if i is not None), default=None)
        return None if first is None else self.rules[first][1]


def learned(index: Index, memory: int = 1 << 16):
    """Column function: label of the best mined rule for an array of token digests (null if none fires)."""
    shared = index

    @F.pandas_udf("string")
    def judge(items: pd.Series) -> pd.Series:
        known: OrderedDict[frozenset, str | None] = OrderedDict()
        out = []
        for x in items:
            key = frozenset(x)
            if key not in known:
                if len(known) >= memory:  # a memo only: the oldest answers go
                    known.popitem(last=False)
                known[key] = shared.judge(key)
            out.append(known[key])
        return pd.Series(out, dtype=object)

    return judge


# ---- the filter -----------------------------------------------------------------
def judged(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = ALLOW,
           min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url)."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = written_rule(F.col("host"), F.col("path"), rules)
    parts = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("label"),
                         tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"))
    mined = mine(parts.select("tokens", "label"), min_support, min_confidence).collect()  # bounded: see above
    index = Index((r.antecedent, r.label, r.confidence, r.support) for r in mined)
    said = learned(index)(F.transform("tokens", lambda t: F.hex(F.xxhash64(t))))
    return parts.withColumn("said", said).select(
        "page_id", "host", "path", "rule", F.coalesce("label", "said", F.lit(default)).alias("verdict"))
