"""URL filter: pattern rules indexed by their rarest literal token (DataFrame functions only).

A rule is a regular expression together with the literal tokens that every URL it matches must contain.  Each rule is
filed under the one of its tokens that the fewest URLs contain (counted over the table).  A URL's tokens fetch its
candidate rules from that index, and only those run their regular expressions; rules without a token are candidates of
every URL.  All of this is one projection without a shuffle, so a host with a third of all pages costs nothing extra;
the index is a constant of the plan, built from blocks of at most ``BLOCK`` rules.

Results for odd input: a null URL or one without ``://`` has empty host and path, no rule, and is blocked; hosts keep
ports and user names; repeated rows are judged alike and returned as often as given; an empty table gives an empty
result."""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 5000
_TOKEN = "[A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``site`` rules decide before pattern rules, the longest name first; among patterns allow beats block."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    site: bool


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains if the URL's path starts with ``path``."""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    regex = r"^(?:[^/?#]*\.)?" + re.sub(r"([^\w/])", r"\\\1", host + path)
    # A run of letters and digits at the rule's end may go on in the URL, so it is no token.
    whole = re.sub(f"{_TOKEN}$", "", host + path) if path else host
    return Rule(host + path, verdict, regex, tuple(re.findall(_TOKEN, whole)), True)


def pattern_rule(name: str, verdict: str, regex: str, *tokens: str) -> Rule:
    return Rule(name, verdict, regex, tokens, False)


#: Site rules of the production query.
SITES = (site_rule("allow", "org", "/"), site_rule("block", "example.org", "/es/"),
         site_rule("block", "example.org", "/en/1"), site_rule("allow", "com", "/fr/"),
         site_rule("block", "com", "/de/"))
#: What decides where no site rule fits: listings reached by page number or referral repeat other pages.
PATTERNS = (pattern_rule("paged", "block", "[?&]page=[0-9]+(?:[&#]|$)", "page"),
            pattern_rule("referral", "block", "[?&]ref=[^&#]", "ref"),
            pattern_rule("document", "allow", r"^[^?#]*\.html(?:#|$)", "html"))


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, host and all that follows); empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    start = F.locate("://", url)
    after = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), upper, lower)
    rest = F.regexp_replace(after, "^[^/?#]*", "")
    return host, F.regexp_extract(rest, "^[^?#]*", 0), F.concat(host, rest)


def url_tokens(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(subject, F.lit(_TOKEN), 0))


def token_counts(subjects: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """URLs holding each token of the rules (bounded by the rules' tokens); ``subjects`` has a column subject."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    found = (subjects.select(F.explode(url_tokens(F.col("subject"))).alias("t"))
             .where(F.col("t").isin(wanted)).groupBy("t").count().collect())
    return {r["t"]: r["count"] for r in found}


def _candidates(tokens: Column, rules: tuple[Rule, ...], counts: dict[str, int]) -> Column:
    """The rules that the tokens fetch from the index (a hash table: buckets of entries filed by token)."""
    width = 1 << max(4, len(rules).bit_length())
    probe = "token string, name string, verdict string, regex string, site boolean"
    buckets: list[list[dict]] = [[] for _ in range(width)]
    always = []
    for r in rules:
        entry = {"token": None, "name": r.name, "verdict": r.verdict, "regex": r.regex, "site": r.site}
        if r.tokens:
            entry["token"] = min(r.tokens, key=lambda t: (counts.get(t, 0), t))
            buckets[_bucket(entry["token"], width)].append(entry)
        else:
            always.append(entry)
    index = F.from_json(F.lit(json.dumps(buckets)), f"array<array<struct<{probe.replace(' ', ':').replace(',:', ',')}>>>")
    fixed = F.from_json(F.lit(json.dumps(always)), f"array<struct<{probe.replace(' ', ':').replace(',:', ',')}>>")
    fetched = F.transform(tokens, lambda t: F.filter(
        F.element_at(index, (F.crc32(t.cast("binary")) % width).cast("int") + 1), lambda e: e["token"] == t))
    return F.concat(F.flatten(fetched), fixed)


def _bucket(token: str, width: int) -> int:
    return zlib.crc32(token.encode()) % width


def judge(pages: DataFrame, sites: tuple[Rule, ...] = SITES, patterns: tuple[Rule, ...] = PATTERNS,
          url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, pattern and verdict (their own columns of these names are replaced)."""
    rules = tuple(sites) + tuple(patterns)
    host, path, subject = split_url(F.col(url))
    counts = token_counts(pages.select(subject.alias("subject")), rules)
    out = pages.withColumns({"host": host, "path": path})
    tokens = url_tokens(subject)
    hits = None
    for lo in range(0, len(rules), BLOCK):
        part = F.filter(_candidates(tokens, rules[lo:lo + BLOCK], counts), lambda e: F.regexp_like(subject, e["regex"]))
        hits = part if hits is None else F.concat(hits, part)
    if hits is None:
        hits = F.expr("cast(array() as array<struct<token:string,name:string,verdict:string,regex:string,site:boolean>>)")
    site = F.array_max(F.transform(F.filter("__hits", lambda e: e["site"]), lambda e: F.struct(
        F.length(e["name"]).alias("len"), e["name"].alias("name"), e["verdict"].alias("verdict"))))
    # Among patterns: allow before block, then by name.
    other = F.array_min(F.transform(F.filter("__hits", lambda e: ~e["site"]), lambda e: F.struct(
        e["verdict"].alias("verdict"), e["name"].alias("name"))))
    ok = F.coalesce(F.contains(F.col(url), F.lit("://")), F.lit(False))
    return (out.withColumn("__hits", hits).withColumns({"__site": site, "__other": other})
            .withColumns({"rule": F.col("__site.name"),
                          "pattern": F.when(F.col("__site").isNull(), F.col("__other.name")),
                          "verdict": F.when(~ok, "block").otherwise(
                              F.coalesce("__site.verdict", "__other.verdict", F.lit("allow")))})
            .drop("__hits", "__site", "__other"))
