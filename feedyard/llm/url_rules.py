"""URL filters by a sort-merge range join over reversed-host keys.

A host is turned into its reversed labels, each closed by a dot
(``www.example.com`` -> ``com.example.www.``). The host and all its
subdomains are then one interval of keys, ``[k, k with its last dot as '/')``
('/' follows '.' directly), and intervals of different rules nest or are
disjoint. URLs and rules are dealt into key ranges, sorted by key, and swept
once with a stack of the rules active at the current key; each URL asks the
stack for the longest rule whose path starts its own.

Ranges come from a bounded sample of keys, which only steers the balance. A
key more frequent than a range is dealt over several ranges by row, so a hot
host or URL does not land in one task. A rule goes to every range that its
interval meets: at most the rules plus, for each nesting level of a host,
the number of ranges.

Defined results: a null url, or one without ``://``, has empty host and path;
it and any url without a rule get the default verdict and a null rule. Ties
cannot arise between different rules; of equal rules (same host and path)
'block' wins, and repeated rows are judged each. Rules with null parts never
fit and are dropped. Empty tables give empty results; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys sampled to place the range boundaries (balance only).
SAMPLE_KEYS = 20_000
#: Rows a range should hold, and the most ranges.
ROWS_PER_RANGE = 200_000
MAX_RANGES = 4_000

OUT = "id long, host string, path string, rule string, verdict string"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to '/', '?', '#' or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """From the host's end up to '?', '#' or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _boundaries(keyed: DataFrame) -> list[str]:
    n = keyed.count()
    ranges = int(min(MAX_RANGES, max(8, n // ROWS_PER_RANGE)))
    share = min(1.0, SAMPLE_KEYS / n) if n else 1.0
    sample = keyed.select("key").sample(share, seed=1).limit(2 * SAMPLE_KEYS).collect()
    keys = sorted(r.key for r in sample)
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []


def _deal(bounds: list[str]):
    cuts = np.array(bounds, dtype=object)

    @F.pandas_udf("int")
    def deal(key: pd.Series, spread: pd.Series) -> pd.Series:
        if not len(cuts):
            return pd.Series(np.zeros(len(key), dtype=np.int32))
        lo = np.searchsorted(cuts, key.to_numpy(dtype=object), "left")
        hi = np.searchsorted(cuts, key.to_numpy(dtype=object), "right")
        # a key that is itself one or more cuts is dealt over the ranges it fills
        return pd.Series((lo + spread.to_numpy() % (hi - lo + 1)).astype(np.int32))

    return deal


class ActiveRules:
    """The rules whose host interval holds the current key, widest first."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, dict[str, tuple[str, str]], list[int]]] = []

    def reach(self, key: str) -> None:
        """Drop rules whose interval ended before ``key``."""
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def add(self, key: str, host: str, path: str, verdict: str) -> None:
        self.reach(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, len(host), {}, []))
        _, _, paths, lengths = self.stack[-1]
        if path not in paths or verdict == "block":
            paths[path] = (host + path, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def longest(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.reach(key)
        best, size = (None, None), (-1, -1)
        for _, host_len, paths, lengths in reversed(self.stack):
            for n in lengths:
                if n <= len(path) and (hit := paths.get(path[:n])):
                    if (host_len + n, host_len) > size:
                        best, size = hit, (host_len + n, host_len)
                    break
        return best


def _sweep(default: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        active, part = ActiveRules(), None
        for pdf in batches:
            found: list[tuple] = []
            for p, key, is_url, rid, host, path, verdict in pdf.itertuples(index=False):
                if p != part:
                    active, part = ActiveRules(), p
                if is_url:
                    rule, said = active.longest(key, path)
                    found.append((rid, host, path, rule, said or default))
                else:
                    active.add(key, host, path, verdict)
            out = pd.DataFrame(found, columns=["id", "host", "path", "rule", "verdict"])
            # an id column with nulls arrives as floats; pandas' Int64 keeps them
            out["id"] = out["id"].astype("Int64")
            yield out
    return run


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str = "allow") -> DataFrame:
    """Judge every url: id_col, host, path, rule (host + path or null), verdict.

    ``rules``: host, path, verdict ('allow' or 'block'). A rule fits its host
    and all subdomains if the url's path starts with the rule's; the longest
    (host + path, then host) wins.
    """
    keyed = urls.select(
        F.col(id_col).cast("long").alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"),
    ).withColumn("key", host_key(F.col("host")))
    ruled = rules.select("host", "path", "verdict").dropna().withColumn("key", host_key(F.col("host")))
    bounds = _boundaries(keyed)
    deal = _deal(bounds)
    zero = F.lit(0).cast("long")
    # a spread of 0 gives the first range a key may lie in, -1 the last
    span = F.sequence(deal(F.col("key"), zero), deal(F.concat(F.rtrim(F.col("key"), F.lit(".")), F.lit("/")), zero - 1))
    placed_rules = ruled.select(
        F.explode(span).alias("part"), "key", F.lit(0).alias("is_url"),
        F.lit(None).cast("long").alias("id"), "host", "path", "verdict",
    )
    placed_urls = keyed.select(
        deal(F.col("key"), F.xxhash64("id", "path")).alias("part"), "key", F.lit(1).alias("is_url"),
        "id", "host", "path", F.lit(None).cast("string").alias("verdict"),
    )
    swept = (
        placed_urls.unionByName(placed_rules)
        .repartition(len(bounds) + 1, "part")
        .sortWithinPartitions("part", "key", "is_url")
        .mapInPandas(_sweep(default), OUT)
    )
    return swept.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict")
