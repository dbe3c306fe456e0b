"""URL filters: pattern rules indexed by their rarest literal token.

Two kinds of rule. A `SiteRule` fits a host with all its subdomains and every path that starts with its path; the
longest that fits decides. A `Pattern` is searched in host, path and what follows; it decides only where no site rule
fits, again the longest first. `*` stands for anything, `^` for a separator or the end, a leading `||` for the start of the host or of
one of its parent domains.

Each rule is filed under the literal token of its own that the URLs hold least often. A URL's tokens fetch its
candidate rules, and only their regular expressions run. Rules travel to the tasks in passes of at most `rules_per_pass`,
each pass keeping the best so far, so that memory stays bounded for lists of any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES_PER_PASS = 50_000
_TOKEN = re.compile(r"[a-z0-9]+")
_URL = re.compile(r"^.*?://([^/?#]*)([^?#]*)(.*)$", re.DOTALL)
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class SiteRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def weight(self) -> int:
        return len(self.name)

    @property
    def regex(self) -> str:
        end = "" if self.path else r"(?![^/?#])"
        return r"\A(?:[^/?#]*\.)?" + re.escape(self.host.translate(_AZ)) + re.escape(self.path) + end

    def tokens(self) -> set[str]:
        """Tokens that every URL this rule fits holds whole; one that ends the path may go on in the URL."""
        found = set(_TOKEN.findall(self.host.translate(_AZ)))
        for m in _TOKEN.finditer(low := self.path.translate(_AZ)):
            if m.end() < len(low):
                found.add(m[0])
        return found


@dataclass(frozen=True)
class Pattern:
    text: str
    verdict: str

    @property
    def name(self) -> str:
        return self.text

    @property
    def weight(self) -> int:
        return len(self.text)

    @property
    def regex(self) -> str:
        host, text = self.text.startswith("||"), self.text.removeprefix("||")
        parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|\Z)"}
        return (r"\A(?:[^/?#]*\.)?" if host else "") + "".join(parts.get(c, re.escape(c)) for c in text)

    def tokens(self) -> set[str]:
        """Tokens bounded on both sides by something that cannot be part of a token."""
        host, text = self.text.startswith("||"), self.text.removeprefix("||").translate(_AZ)
        found = set()
        for m in _TOKEN.finditer(text):
            left = host if m.start() == 0 else text[m.start() - 1] != "*"
            right = m.end() < len(text) and text[m.end()] != "*"
            if left and right:
                found.add(m[0])
        return found


Rule = SiteRule | Pattern


def _token_counts(pages: DataFrame, url: str, tokens: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' own tokens; no more rows than there are such tokens."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url)), F.lit("([a-z0-9]+)"), F.lit(1)))
    counts = (
        pages.select(F.explode(found).alias("token"))
        .where(F.col("token").isin(sorted(tokens)))
        .groupBy("token").count()
    )
    return {r["token"]: r["count"] for r in counts.collect()}


@dataclass
class _Index:
    """Compiled rules by token; those without a sure token are tried on every URL."""

    by_token: dict[str, list] = field(default_factory=dict)
    always: list = field(default_factory=list)

    def add(self, rule: Rule, counts: dict[str, int]) -> None:
        site = isinstance(rule, SiteRule)
        entry = ((site, rule.weight, rule.name, rule.verdict), re.compile(rule.regex, re.DOTALL))
        rarest = min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default=None)
        (self.always if rarest is None else self.by_token.setdefault(rarest, [])).append(entry)

    def best(self, target: str, so_far: tuple | None) -> tuple | None:
        entries = list(self.always)
        for token in set(_TOKEN.findall(target.translate(_AZ))):
            entries += self.by_token.get(token, ())
        for rank, regex in entries:
            if (so_far is None or rank > so_far) and regex.search(target):
                so_far = rank
        return so_far


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, rest); all empty without ``://``."""
    m = _URL.match(url or "")
    return (m[1].translate(_AZ), m[2], m[3]) if m else ("", "", "")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url", default: str = "allow",
    rules_per_pass: int = RULES_PER_PASS,
) -> DataFrame:
    """One row per page: key, host, path, rule, pattern, verdict.

    ``rule`` is the site rule that decided, ``pattern`` the pattern that did where no site rule fits, else NULL. A NULL
    URL or one without ``://`` has empty host and path, no site rule can fit it, and patterns see an empty text. Repeated
    rows stay; other columns are left out. An empty table gives an empty result.
    """
    counts = _token_counts(pages, url, set().union(*(r.tokens() for r in rules))) if rules else {}
    key_type = pages.schema[key].dataType.simpleString()
    best_type = "struct<site:boolean,weight:bigint,name:string,verdict:string>"
    judged = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.lit(None).cast(best_type).alias("best"))

    def apply(block: Sequence[Rule]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _Index()
            for rule in block:
                index.add(rule, counts)
            for batch in batches:
                best = []
                for text, old in zip(batch["url"].to_pylist(), batch["best"].to_pylist(), strict=True):
                    found = index.best("".join(split_url(text)), tuple(old.values()) if old else None)
                    best.append(found and dict(zip(("site", "weight", "name", "verdict"), found, strict=True)))
                arrow = pa.struct([("site", pa.bool_()), ("weight", pa.int64()), ("name", pa.string()), ("verdict", pa.string())])
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["url"], pa.array(best, arrow)], names=["key", "url", "best"]
                )
        return run

    for first in range(0, len(rules), rules_per_pass):
        judged = judged.mapInArrow(
            apply(rules[first : first + rules_per_pass]), f"key {key_type}, url string, best {best_type}"
        )
    part = lambda i: F.coalesce(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return judged.select(
        F.col("key").alias(key),
        F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        part(2).alias("path"),
        F.when(F.col("best.site"), F.col("best.name")).alias("rule"),
        F.when(~F.col("best.site"), F.col("best.name")).alias("pattern"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
