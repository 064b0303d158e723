"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that any matching URL must hold. The rarest of them,
counted over the URLs at hand, is its index key. A URL is split into tokens, the tokens that are keys fetch
candidate rules, and only those candidates run their regular expressions. Everything is a column expression:
no shuffle but the token count's, whose result has at most one row per rule token.

Edge cases: a null URL, or one without ``://``, has empty host and path, no rule, and the default verdict; rules
without literal tokens are tried on every URL; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_BREAK = "[^a-z0-9]+"
#: Rules per index literal; longer lists are applied as several indexes, one after another.
INDEX_RULES = 2000


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with its subdomains and a path prefix; longer rules weigh more."""
    name = f"{host}{path}"
    complete = path if path.endswith("/") else path[: path.rfind("/") + 1]
    tokens = tuple(t for t in re.split(TOKEN_BREAK, f"{host}{complete}".lower()) if t)
    return Rule(name, verdict, rf"^(?:[^\n]*\.)?\Q{host}\E\n\Q{path}\E", tokens, len(name))


#: The four rules that decide first (fixed values).
SITE_RULES = (
    site_rule("net", "/", "block"),
    site_rule("example.net", "/en/", "allow"),
    site_rule("example.com", "/de/", "block"),
    site_rule("org", "/fr/", "allow"),
)


def pattern_rule(name: str, pattern: str, *tokens: str) -> Rule:
    return Rule(name, "block", pattern, tokens, len(name))


#: Patterns over ``host newline path`` that block where no site rule fits (fixed values).
PATTERN_RULES = (
    pattern_rule("ads host label", r"^(?:[^\n]*[.-])?ads[.-]", "ads"),
    pattern_rule("ad host label", r"^(?:[^\n]*\.)?ad\.", "ad"),
    pattern_rule("adserver host", r"^(?:[^\n]*[.-])?adserver[.-]", "adserver"),
    pattern_rule("tracker host label", r"^(?:[^\n]*[.-])?tracker[.-]", "tracker"),
    pattern_rule("tracking host label", r"^(?:[^\n]*[.-])?tracking[.-]", "tracking"),
    pattern_rule("doubleclick host", r"^(?:[^\n]*\.)?doubleclick\.", "doubleclick"),
    pattern_rule("banner path", r"\n(?:.*/)?banners?/", "banner"),
    pattern_rule("banners path", r"\n(?:.*/)?banners/", "banners"),
    pattern_rule("popup path", r"\n(?:.*/)?popup/", "popup"),
    pattern_rule("casino host", r"^(?:[^\n]*[.-])?casino[.-]", "casino"),
    pattern_rule("porn host", r"^(?:[^\n]*[.-])?porn[.-]", "porn"),
)


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(subject: Column) -> Column:
    return F.filter(F.split(F.lower(subject), TOKEN_BREAK), lambda t: t != "")


def rarest_tokens(subjects: DataFrame, rules) -> dict[str, str]:
    """For each rule's name its rarest token among the subjects (column ``subject``); ties go to the longer token."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    hits = subjects.select(F.explode(F.array_distinct(F.filter(_tokens(F.col("subject")), lambda t: t.isin(wanted)))).alias("token"))
    seen = {r["token"]: r["n"] for r in hits.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {r.name: min(r.tokens, key=lambda t: (seen.get(t, 0), -len(t), t)) for r in rules if r.tokens}


def _one_of(tokens: list[str]):
    return lambda t: t.isin(tokens)


def _from(index: Column):
    return lambda t: F.element_at(index, t)


def best_rule(subject: Column, rules, keys: dict[str, str]) -> Column:
    """The heaviest fitting rule as struct(weight, name, verdict), null if none fits."""
    entry = lambda r: F.struct(F.lit(r.weight).alias("weight"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"))
    found = []
    for at in range(0, len(rules), INDEX_RULES):
        some = rules[at : at + INDEX_RULES]
        index: dict[str, list[Rule]] = {}
        for r in some:
            if r.tokens:
                index.setdefault(keys[r.name], []).append(r)
        sets = [F.array(*[entry(r) for r in some if not r.tokens])] if any(not r.tokens for r in some) else []
        if index:
            by_token = F.create_map(*[x for t, rs in sorted(index.items()) for x in (F.lit(t), F.array(*[entry(r) for r in rs]))])
            hits = F.array_distinct(F.filter(_tokens(subject), _one_of(sorted(index))))
            sets.append(F.flatten(F.transform(hits, _from(by_token))))
        for candidates in sets:
            fits = F.filter(candidates, lambda r: F.rlike(subject, r["pattern"]))
            found.append(F.array_max(F.transform(fits, lambda r: F.struct(r["weight"], r["name"], r["verdict"]))))
    return found[0] if len(found) == 1 else F.greatest(*found) if found else F.lit(None).cast("struct<weight:int,name:string,verdict:string>")


def judge(pages: DataFrame, site_rules=SITE_RULES, pattern_rules=PATTERN_RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (a site rule's name), verdict, and reason (the pattern rule's name where it decided)."""
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    parts = parts.withColumn("subject", F.concat("host", F.lit("\n"), "path"))
    keys = rarest_tokens(parts, [*site_rules, *pattern_rules])
    ruled = parts.withColumn("by_site", best_rule(F.col("subject"), list(site_rules), keys)).withColumn("by_pattern", best_rule(F.col("subject"), list(pattern_rules), keys))
    return ruled.select(
        "page_id", "host", "path", F.col("by_site.name").alias("rule"),
        F.coalesce("by_site.verdict", "by_pattern.verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("by_site").isNull(), F.col("by_pattern.name")).alias("reason"),
    )
