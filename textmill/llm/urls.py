"""URL verdicts by a sort-merge range join with prefix rules.

A rule such as ``example.org/es/`` fits a host, all its subdomains and every
path that starts with the rule's.  Reversed, label by label, a host becomes a
key (``org.example.``) that is a prefix of the keys of its subdomains, so rule
hosts are intervals of the key order, nested or apart.  URLs are range-sorted
by key and path; each task sweeps its part once and keeps a stack of the rule
hosts whose interval it is in.  On every host of the stack the paths are again
nested intervals, found by bisection.  The longest rule wins; of equally long
ones that of the longer host, and block before allow for the same rule.

Rules go to the tasks in blocks of ``RULE_BLOCK``; with more rules than that the
sorted URLs pass one block after another and keep the best rule so far, by the
same order, so that blocks change no verdict.

Defined results: a null URL or one without ``://`` has empty host and path; an
empty host fits no rule; URLs without a fitting rule get the ``default`` verdict;
repeated rows are judged each; null ids are kept; rules that are null or have
no host take no part; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import map_rows, shared, table
from textmill.session import written

RULE_BLOCK = 200_000
#: The rules of the registered query (fixed values of its contract).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def reversed_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class Nested:
    """Sorted prefixes with, for each, the next shorter one that holds it."""

    def __init__(self, prefixes):
        self.starts = sorted(prefixes)
        self.outer: list[int] = []
        stack: list[int] = []
        for i, p in enumerate(self.starts):
            while stack and not p.startswith(self.starts[stack[-1]]):
                stack.pop()
            self.outer.append(stack[-1] if stack else -1)
            stack.append(i)

    def innermost(self, text: str) -> int:
        """The longest prefix of ``text``, or -1."""
        i = bisect_right(self.starts, text) - 1
        while i >= 0 and not text.startswith(self.starts[i]):
            i = self.outer[i]
        return i


def weight(rule: str, verdict: str) -> tuple:
    """What wins among fitting rules: the longest, of these the one of the longer
    host, then block before allow, then the later in order."""
    return len(rule), len(rule.partition("/")[0]), verdict, rule


class RuleSet:
    """Nested rule hosts, each with its nested paths: {path: (rule, verdict)}."""

    def __init__(self, rules):
        by_host: dict[str, dict] = {}
        for verdict, rule in sorted(rules):  # allow before block, so block stays
            host, slash, path = rule.partition("/")
            by_host.setdefault(reversed_key(host.translate(str.maketrans(_UPPER, _LOWER))), {})[slash + path] = (rule, verdict)
        self.hosts = Nested(by_host)
        self.paths = [Nested(by_host[k]) for k in self.hosts.starts]
        self.rules = [[by_host[k][p] for p in n.starts] for k, n in zip(self.hosts.starts, self.paths)]

    def sweep(self, state: dict, key: str, path: str):
        """The best (rule, verdict) of a URL; ``state`` holds the stack between
        URLs in key order."""
        starts = self.hosts.starts
        stack = state.get("stack")
        if stack is None:  # the first URL of the task: its enclosing hosts
            stack, i = [], self.hosts.innermost(key)
            while i >= 0:
                stack.insert(0, i)
                i = self.hosts.outer[i]
            state |= {"stack": stack, "next": bisect_right(starts, key)}
        while state["next"] < len(starts) and starts[state["next"]] <= key:
            while stack and not starts[state["next"]].startswith(starts[stack[-1]]):
                stack.pop()
            stack.append(state["next"])
            state["next"] += 1
        while stack and not key.startswith(starts[stack[-1]]):
            stack.pop()
        best = None
        for i in reversed(stack):
            p = self.paths[i].innermost(path)
            if p >= 0 and (best is None or weight(*self.rules[i][p]) > weight(*best)):
                best = self.rules[i][p]
        return best


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", rule_block: int = RULE_BLOCK) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id,
    url); ``rules`` has (verdict, rule)."""
    url = F.coalesce("url", F.lit(""))
    parted = pages.select("page_id", F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER).alias("host"),
                          F.regexp_extract(url, _URL, 2).alias("path"))
    key = F.concat(F.array_join(F.reverse(F.split("host", r"\.", -1)), "."), F.lit("."))
    now = parted.select("*", key.alias("key"), F.lit(None).cast("string").alias("rule"),
                        F.lit(None).cast("string").alias("verdict"))
    usable = rules.filter("verdict is not null and rule is not null and rule not like '/%' and rule <> ''").select("verdict", "rule")
    blocks = -(-usable.count() // rule_block) or 1
    names = now.columns
    for n in range(blocks):
        block = usable.filter(F.pmod(F.xxhash64("rule"), F.lit(blocks)) == n)
        sent = shared(pages.sparkSession, RuleSet([tuple(r) for r in block.collect()]))

        def run(batches, sent=sent):
            state: dict = {}
            rules = sent()
            for b in batches:
                for i, (key, path, old) in enumerate(zip(b["key"], b["path"], zip(b["rule"], b["verdict"]))):
                    best = rules.sweep(state, key, path) if b["host"][i] else None
                    if best and (old[0] is None or weight(*best) > weight(*old)):
                        b["rule"][i], b["verdict"][i] = best
                yield b

        if n:
            now = written(now, "judged")
        dealt = now.repartitionByRange("key", "path", "page_id").sortWithinPartitions("key", "path", "page_id")
        now = map_rows(dealt, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in now.schema)).select(*names)
    return now.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op6_url_rules(spark, sf_dir):
    """Every page's URL under the five rules."""
    rules = spark.createDataFrame(RULES, "verdict string, rule string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


OP6_SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
f AS (
  SELECT *, host = 'org' OR host LIKE '%.org' AS org, host = 'example.org' OR host LIKE '%.example.org' AS ex,
         host = 'com' OR host LIKE '%.com' AS com FROM u),
r AS (
  SELECT page_id, host, path,
         CASE WHEN ex AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN ex AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN com AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN com AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN org AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM f)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
