"""URL filters: pattern rules behind an index of their rarest literal tokens.

A rule is a regular expression over ``host + path`` with the literal tokens (runs of letters
and digits) that every match must contain whole. The index files each rule under its rarest
token, by counts over all URLs. A URL's tokens fetch the rules filed under them, and only
those run their expression; rules without a token run on every URL. Of the rules that fit, the
longest wins (then the first given).

Rules are a configured list, which goes to every task; what is counted for the index are the
rules' own tokens, so its size follows the rules and not the pages.

Cases: null or no ``://``: host and path empty; a rule fits its host and all subdomains, where
the path starts with the rule's; only A-Z are lower-cased and only in hosts; every row gives a
row, also rows that repeat an id or have none; no rules: everything gets the default; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TOKEN = re.compile(rb"[0-9a-z]+")


@dataclass(frozen=True)
class Rule:
    """A named pattern with its verdict; ``tokens`` are lower-cased."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[bytes, ...]
    listed: bool = True  # named in the result


def host_rule(verdict: str, rule: str) -> Rule:
    """``host/path``: the host with its subdomains, and paths that start with ``/path``."""
    host, slash, path = rule.partition("/")
    literal = (host + slash + path).encode().lower()
    # A token at the very end may go on in the URL, unless the rule is a host only.
    tokens = [m.group() for m in _TOKEN.finditer(literal)
              if not slash or m.end() < len(literal)]
    end = "" if slash else "(?:/|$)"
    return Rule(rule, verdict, f"^(?:[^/]*\\.)?{re.escape(host)}{re.escape(slash + path)}{end}",
                tuple(tokens))


def wildcard_rule(verdict: str, pattern: str) -> Rule:
    """``*`` stands for anything, ``^`` for a separator or the end; matches anywhere."""
    parts = re.split(r"([*^])", pattern)
    expression = "".join({"*": ".*", "^": r"(?:[^0-9A-Za-z]|$)"}.get(p, re.escape(p)) for p in parts)
    raw, tokens = pattern.encode().lower(), []
    for m in _TOKEN.finditer(raw):
        before, after = raw[m.start() - 1:m.start()], raw[m.end():m.end() + 1]
        if before not in (b"", b"*") and after not in (b"", b"*"):
            tokens.append(m.group())
    return Rule(pattern, verdict, expression, tuple(tokens), listed=False)


#: Wildcards for pages that are no documents; these give the verdict where no listed rule fits.
PATTERNS = tuple(wildcard_rule("block", p) for p in (
    "/wp-login.php^", "/cgi-bin/", "/user/login^", "/cart/checkout^", ".tar.gz^", ".iso^"))


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = re.split(r"[?#]", url[at + 3:], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def url_tokens(target: str) -> set[bytes]:
    return set(_TOKEN.findall(target.encode("utf-8", "surrogatepass").lower()))


class Index:
    """Rules by their rarest token."""

    def __init__(self, rules: Sequence[Rule], counts: dict[bytes, int]):
        self.filed: dict[bytes, list[tuple[int, Rule, re.Pattern]]] = {}
        self.always: list[tuple[int, Rule, re.Pattern]] = []
        for k, rule in enumerate(rules):
            entry = k, rule, re.compile(rule.pattern, re.DOTALL)
            if rule.tokens:
                token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
                self.filed.setdefault(token, []).append(entry)
            else:
                self.always.append(entry)

    def candidates(self, target: str) -> list[tuple[int, Rule, re.Pattern]]:
        found = list(self.always)
        for token in url_tokens(target):
            found += self.filed.get(token, ())
        return found

    def best(self, target: str) -> Rule | None:
        """The longest listed rule that fits, else the longest other one."""
        fits = [(rule.listed, len(rule.name), -k, rule)
                for k, rule, pattern in self.candidates(target) if pattern.search(target)]
        return max(fits, key=lambda f: f[:3])[3] if fits else None


def token_counts(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> dict[bytes, int]:
    """URLs that have each token of the rules."""
    wanted = {t for rule in rules for t in rule.tokens}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for value in batch.column("url").to_pylist():
                total.update(url_tokens("".join(split_url(value))) & wanted)
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()),
                                          pa.array(total.values(), pa.int64())], ["token", "n"])

    rows = pages.select(F.col(url).alias("url")).mapInArrow(run, "token binary, n bigint")
    return {bytes(r.token): r.n for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow",
          page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict."""
    index_counts = token_counts(pages, rules, url)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules, index_counts)
        for batch in batches:
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            best = [index.best(host + path) for host, path in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([h for h, _ in parts], pa.string()),
                 pa.array([p for _, p in parts], pa.string()),
                 pa.array([b.name if b and b.listed else None for b in best], pa.string()),
                 pa.array([b.verdict if b else default for b in best], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
