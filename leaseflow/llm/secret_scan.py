"""Secret scans: known forms, and strings that a tokenizer can't compress.

Three base kinds are patterns: ``assign`` (a password, secret, token or key given a value of 8
characters or more), ``access`` (access key ids) and ``hex`` (runs of 32 or more hexadecimal
digits). The fourth, ``random``, is the token-efficiency test: a byte-pair vocabulary trained
on text has long pieces for words and names and hardly any for random characters, so a string
with few characters a token is random. Candidates are runs of 20 or more key characters that
meet no base span and are no known digest (hexadecimal of a common digest's length, either
case) and no identifier (a UUID, a number, date or version, a name made of words and short
numbers); one is reported when characters divided by tokens is at most 1.8. Of random strings of
20 letters and digits 99 % are at or below 1.8, and names and words are mostly above 2.

A scan by the linear-time patterns of Arrow says which texts can hold anything; the exact
patterns run on these alone. Spans count code points.

Rules: null and empty texts have no spans; every row gives a row, also rows that repeat an id
or have none; texts are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
VALUE, ACCESS, HEX, RANDOM = 8, 16, 32, 20
#: Most characters a token of a random string.
RATIO = 1.8
#: Characters encoded at a time, which bounds the time for one very long run.
PART = 4096
CACHED = 50_000

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(r"AKIA[A-Z0-9]+")
_hex = re.compile(r"[0-9a-f]{%d,}" % HEX)
_random = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RANDOM)
#: Texts that match none of these have no span; matching one proves nothing.
_ANY = "|".join([r"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=])", "AKIA",
                 r"[0-9a-f]{%d}" % HEX, r"[A-Za-z0-9+/_=-]{%d}" % RANDOM])

# Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGESTS = frozenset({32, 40, 56, 64, 96, 128})
_digest = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_uuid = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_number = re.compile(r"[0-9+/_=-]+(T[0-9]+Z?)?")
#: Words (lower, upper or capitalised) and numbers, of which names are made.
_parts = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

Span = tuple[str, int, int]


@cache
def _encoding(path: str):
    import tiktoken
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    import public_tokenizers
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Efficiency(dict):
    """Characters a token of different strings; short ones are remembered."""

    def __init__(self, path: str):
        self.encode = _encoding(path).encode_ordinary

    def __missing__(self, run: str) -> float:
        tokens = sum(len(self.encode(run[at:at + PART])) for at in range(0, len(run), PART))
        ratio = len(run) / tokens
        if len(run) <= 128:
            if len(self) >= CACHED:
                self.clear()
            self[run] = ratio
        return ratio


@cache
def _efficiency(path: str) -> Efficiency:
    return Efficiency(path)


def is_digest(run: str) -> bool:
    return len(run) in DIGESTS and _digest.fullmatch(run) is not None


def is_identifier(run: str) -> bool:
    """A UUID, a number, date or version, or a name: parts of 5 characters or more on average,
    numbers of 4 digits at most."""
    if _uuid.fullmatch(run) or _number.fullmatch(run):
        return True
    parts = _parts.findall(run)
    return len(run) >= 5 * len(parts) and all(len(p) <= 4 for p in parts if p.isdigit())


def base_spans(text: str) -> list[Span]:
    """Spans of the three base kinds, each kind leftmost and non-overlapping."""
    spans = [("assign", m.start(), m.end()) for m in _assign.finditer(text) if len(m[2]) >= VALUE]
    spans += [("access", m.start(), m.end()) for m in _access.finditer(text) if m.end() - m.start() >= ACCESS]
    spans += [("hex", m.start(), m.end()) for m in _hex.finditer(text)]
    return spans


def random_spans(text: str, efficiency: Efficiency, taken: list[Span], most: float = RATIO) -> list[Span]:
    """Runs outside the taken spans that cost the tokenizer many tokens."""
    out, taken, at = [], sorted((a, b) for _, a, b in taken), 0
    for m in _random.finditer(text):
        start, end = m.span()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if any(a < end and b > start for a, b in taken[at:at + 4]):
            continue
        run = m.group().rstrip("=/-_+")
        if len(run) < RANDOM or is_digest(run) or is_identifier(run):
            continue
        if efficiency[run] <= most:
            out.append(("random", start, start + len(run)))
    return out


def scan(text: str | None, path: str, most: float = RATIO) -> list[Span]:
    """All spans of one text, by start and kind."""
    if not text:
        return []
    spans = base_spans(text)
    spans += random_spans(text, _efficiency(path), spans, most)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                 most: float = RATIO) -> DataFrame:
    """One row per input row: doc_id, found (array of kind, start, end).

    ``vocabulary`` is the path of a tiktoken vocabulary, the same on every executor.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            maybe = pc.fill_null(pc.match_substring_regex(texts, _ANY), False).to_pylist()
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(texts[i].as_py(), vocabulary, most)]
                     if some else [] for i, some in enumerate(maybe)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, SPANS)], ["doc_id", "found"])

    return rows.mapInArrow(run, f"doc_id {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of found spans."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"),
                                                                     s.end.cast("string"))), ",")

    def counted(kind: str):
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s.kind != "random")
    return found.select("doc_id", *[counted(k) for k in KINDS[:3]],
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
                        counted("random"))
