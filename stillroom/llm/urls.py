"""URL rules looked up by their rarest token.

A prefix rule has a host and the beginning of a path; it fits the host and its subdomains, and the longest that fits
decides. Pattern rules are regular expressions over the whole URL, A-Z lower-cased; they decide where no prefix rule
fits: the URL is blocked if one of them is found in it, else allowed.

Every rule is filed under one of its literal tokens (runs of a-z and 0-9 that any URL it fits must hold whole), the one
that the fewest URLs have. A rule without such a token is filed under the beginning of one. A URL's tokens and their
beginnings fetch the rules filed under them, and only those are compared with it. A rule without either is filed under
the empty token, which every URL has.

Defined results: a null URL, or one without ``://``, has an empty host and path; no prefix rule fits it, and pattern
rules see it as it is (null: allowed). Rows that repeat a page are judged each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import LOWER, UPPER, stored

SPLIT = "[^a-z0-9]+"
#: Ends the beginning of a token, to tell it from a whole one.
OPEN = "*"
#: ``\b`` between ASCII letters, digits and low lines and all else, in every Java version.
BOUNDARY = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
#: Parts of a regular expression: an escape, a class or a character.
PARTS = r"\\.|\[(?:\\.|[^\]\\])*\]|."


@dataclass(frozen=True)
class Prefix:
    """``allow`` or ``block`` for a host with all its subdomains, below the beginning of a path."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def tokens(self) -> set[str]:
        """The labels of the host, and those of the path but for the last, which a URL may carry on."""
        path = re.split(SPLIT, self.path)[:-1]
        return {x for x in [*re.split(SPLIT, self.host), *path] if x}

    keys = tokens


@dataclass(frozen=True)
class Pattern:
    """A regular expression that blocks."""

    regex: str

    def alternatives(self) -> list[Pattern]:
        """Patterns of which one is found where this one is: a group of plain words is taken apart, and one that may be
        left out is put in and left out, so that each of them can be filed under a token of its own. Groups within
        groups, and those that are referred to, stay as they are."""
        parts, start, depth = re.findall(PARTS, self.regex, re.S), 0, 0
        if any(re.fullmatch(r"\\[1-9k]", part) for part in parts):
            return [self]
        for end, part in enumerate(parts):
            start = end if part == "(" and depth == 0 else start
            depth += (part == "(") - (part == ")")
            if part != ")" or depth:
                continue
            inner, after = parts[start + 1 : end], "".join(parts[end + 1 : end + 3])
            if re.fullmatch(r"[a-z0-9_-]+(\|[a-z0-9_-]+)+", "".join(inner)) and after[:1] not in ("?", "*", "+", "{"):
                options, rest = "".join(inner).split("|"), parts[end + 1 :]
            elif inner and inner[0] != "?" and not {"(", "|"} & set(inner) and after[:1] == "?" and after[1:2] not in ("?", "+"):
                options, rest = ["", "".join(inner)], parts[end + 2 :]
            else:
                continue
            return [p for x in options for p in Pattern("".join([*parts[:start], x, *rest])).alternatives()]
        return [self]

    def runs(self) -> set[tuple[str, bool]]:
        """Runs of small letters and digits after ``\\b`` or a literal mark, and whether one follows too. A rule with
        groups or alternatives, whose parts need not all be there, has none."""
        if re.search(r"[(|]", self.regex):
            return set()
        found, run, bounded = set(), "", False
        for part in [*re.findall(r"\\.[?*+{]?|\[[^\]]*\][?*+{]?|.[?*+{]|.", self.regex, re.S), r"$"]:
            if re.fullmatch(r"[a-z0-9]", part):
                run += part
                continue
            mark = re.fullmatch(r"\\b|\\[^A-Za-z0-9]|[/_:-]", part) is not None
            if run and bounded:
                found.add((run, mark))
            run, bounded = "", mark
        return found

    def tokens(self) -> set[str]:
        """Runs that any URL must hold whole."""
        return {run for run, whole in self.runs() if whole}

    def keys(self) -> set[str]:
        """The tokens, or where there are none the beginnings of some."""
        return self.tokens() or {run + OPEN for run, _ in self.runs()}

    def java(self) -> str:
        return "".join(BOUNDARY if part == r"\b" else part for part in re.findall(PARTS, self.regex, re.S))


def unfiled(rules: list[Prefix | Pattern]) -> list[str]:
    """Rules with a part that has nothing to be filed under, so that every URL is compared with it."""
    parts = [(r, r.alternatives() if isinstance(r, Pattern) else [r]) for r in rules]
    return [r.name if isinstance(r, Prefix) else r.regex for r, of in parts if not all(p.keys() for p in of)]


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.regexp_extract(url, "(?s)://(.*)$", 1), "/", 1)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def beginnings(tokens: Column, length: int) -> Column:
    return F.transform(F.filter(tokens, lambda t: F.length(t) >= length), lambda t: F.concat(F.substring(t, 1, length), F.lit(OPEN)))


def judge(pages: DataFrame, prefixes: list[Prefix], patterns: list[Pattern]) -> DataFrame:
    """A row for each page: page_id, host, path, rule (the prefix rule that decides, else null), verdict and blocked_by
    (the pattern rules found, in order)."""
    spark = pages.sparkSession
    urls = pages.select(pages["page_id"], pages["url"]).groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("rows"))
    urls = stored(urls.select("page_id", "url", "rows", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.translate("url", UPPER, LOWER).alias("small")), "urls")

    rules = [(k, r.name, r.verdict, r.host, r.path, None, sorted(r.keys())) for k, r in enumerate(prefixes)]
    parts = [(r, part) for r in patterns for part in r.alternatives()]
    rules += [(len(prefixes) + k, r.regex, "block", None, None, part.java(), sorted(part.keys())) for k, (r, part) in enumerate(parts)]
    listed = spark.createDataFrame(rules, "rule_id int, name string, rule_verdict string, rule_host string, rule_path string, regex string, tokens array<string>")

    whole = F.coalesce(F.array_remove(F.split("small", SPLIT), ""), F.array().cast("array<string>"))
    lengths = sorted({len(key) - len(OPEN) for *_, keys in rules for key in keys if key.endswith(OPEN)})
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), whole, *(beginnings(whole, n) for n in lengths)))
    tokened = urls.select("page_id", "url", "host", "path", "small", F.explode(tokens).alias("token"))

    offered = listed.select("rule_id", F.explode_outer("tokens").alias("token"))
    frequency = tokened.join(F.broadcast(offered.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = offered.join(frequency, "token", "left").groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")))["token"].alias("token"))
    filed = stored(listed.drop("tokens").join(rarest, "rule_id"), "filed-rules")

    candidates = tokened.join(filed, "token")
    host_fits = (F.col("host") == F.col("rule_host")) | F.endswith(F.col("host"), F.concat(F.lit("."), F.col("rule_host")))
    prefix_fits = F.col("regex").isNull() & host_fits & F.startswith(F.col("path"), F.col("rule_path"))
    fits = F.when(F.col("regex").isNotNull(), F.regexp_like("small", F.col("regex"))).otherwise(prefix_fits)
    weight = F.struct((F.length("rule_host") + F.length("rule_path")).alias("length"), F.length("rule_host").alias("host"), (-F.col("rule_id")).alias("order"))
    decided = candidates.filter(fits).groupBy("page_id", "url").agg(
        F.max_by(F.when(F.col("regex").isNull(), F.struct("name", "rule_verdict")), F.when(F.col("regex").isNull(), weight)).alias("prefix"),
        F.sort_array(F.collect_set(F.when(F.col("regex").isNotNull(), F.col("name")))).alias("blocked_by"),
    )
    decided = decided.select(F.col("page_id").alias("id"), F.col("url").alias("address"), "prefix", "blocked_by")
    out = urls.join(decided, F.col("page_id").eqNullSafe(F.col("id")) & F.col("url").eqNullSafe(F.col("address")), "left")
    found = F.coalesce("blocked_by", F.array().cast("array<string>"))
    verdict = F.coalesce(F.col("prefix.rule_verdict"), F.when(F.size(found) > 0, "block").otherwise("allow"))
    out = out.select("page_id", "host", "path", F.col("prefix.name").alias("rule"), verdict.alias("verdict"), found.alias("blocked_by"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row"))
    return out.drop("row")
