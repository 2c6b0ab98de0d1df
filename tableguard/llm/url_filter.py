"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that every matching URL must hold.  A
Spark job counts the rules' tokens over all URLs; each rule is filed under its rarest token
(ties by the token).  A URL's tokens fetch the candidate rules, and only those run their
expression.  The rule list is a parameter of fixed size, and only one count for each rule token
reaches the driver.

Host: what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path: then up to ``?``, ``#`` or the end.  A site rule ``host/path`` fits its host and all
subdomains if the URL's path starts with the rule's; the longest fitting site rule decides.
Where none fits, the strongest matching pattern (block before allow, then the longest, then by
text) decides, and else ``DEFAULT``.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no rule and the
default verdict; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import batch_of

# The site rules (verdict, host/path).
SITES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
# The method's own patterns: (verdict, expression on "host path?query", literal tokens).
PATTERNS = [
    ("block", r"[?&]utm_source=feed\b", ("utm", "source", "feed")),
    ("block", r"[?&]phpsessid=", ("phpsessid",)),
    ("block", r"\.exe(?:[?#]|$)", ("exe",)),
    ("block", r"\.zip(?:[?#]|$)", ("zip",)),
    ("block", r"\bcasino\b", ("casino",)),
    ("block", r"/login(?:[/?#]|$)", ("login",)),
    ("block", r"/cart(?:[/?#]|$)", ("cart",)),
    ("allow", r"\bexample\.org/en/\d+", ("example", "org", "en")),
]
DEFAULT = "allow"
_TOKEN = re.compile(r"[0-9a-z]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
_HOST = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")
SCHEMA = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                    ("verdict", pa.string()), ("pattern", pa.string()), ("n_tested", pa.int64())])
DDL = "page_id long, host string, path string, rule string, verdict string, pattern string, n_tested long"


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, everything after ``://`` with A-Z lower-cased)."""
    head, sep, rest = (url or "").partition("://")
    if not sep:
        return "", "", ""
    host = _HOST.match(rest).group()
    return host.translate(_UPPER), _PATH.match(rest, len(host)).group(), rest.translate(_UPPER)


def rules(sites, patterns) -> list[tuple]:
    """(kind, verdict, name, expression, tokens); a site's path is compared as it is written."""
    made = []
    for verdict, name in sites:
        host, slash, path = name.partition("/")
        made.append(("site", verdict, name,
                     re.compile(rf"(?:[^/]*\.)?{re.escape(host)}\n{re.escape(slash + path)}"),
                     tuple(_TOKEN.findall(host))))
    for verdict, text, tokens in patterns:
        made.append(("pattern", verdict, text, re.compile(text), tokens))
    return made


def token_counts(urls: DataFrame, wanted: list[str]) -> dict[str, int]:
    """Number of URLs that hold each wanted token."""
    tokens = F.array_distinct(F.split(F.lower(F.coalesce(F.col("url"), F.lit(""))), "[^0-9a-z]+"))
    row = urls.select(*(F.count_if(F.array_contains(tokens, w)).alias(f"t{i}")
                        for i, w in enumerate(wanted))).first()
    return dict(zip(wanted, row))


def filter_urls(pages: DataFrame, sites=SITES, patterns=PATTERNS, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern (the pattern that decided) and n_tested (how
    many expressions ran)."""
    made = rules(sites, patterns)
    count = token_counts(pages, sorted({t for r in made for t in r[4]}))

    def task(batches):
        index: dict[str, list[tuple]] = {}
        for r in rules(sites, patterns):
            index.setdefault(min(r[4], key=lambda t: (count[t], t)), []).append(r)
        for b in batches:
            rows = [judge(u, index, default) for u in b.column("url").to_pylist()]
            yield batch_of(SCHEMA, [b.column("page_id"), *([list(x) for x in zip(*rows)] if rows else [[]] * 6)])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(task, DDL)


def judge(url: str | None, index: dict[str, list[tuple]], default: str) -> tuple:
    host, path, rest = split_url(url)
    site, found, tested = None, [], 0
    for token in set(_TOKEN.findall(rest)):
        for kind, verdict, name, expression, _ in index.get(token, ()):
            tested += 1
            if kind == "site":
                if expression.match(f"{host}\n{path}") and (site is None or len(name) > len(site[0])):
                    site = (name, verdict)
            elif expression.search(rest):
                found.append((verdict != "block", -len(name), name, verdict))
    if site:
        return host, path, site[0], site[1], None, tested
    if found:
        best = min(found)
        return host, path, None, best[3], best[2], tested
    return host, path, None, default, None, tested
