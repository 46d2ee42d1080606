"""Secret scanning with a trigram inverted index.

From every rule's pattern a Boolean query over trigrams is derived: a text that the pattern matches must satisfy
it. Each task builds, for one block of documents at a time, the postings of all trigrams the queries name, combines
them by AND and OR, and runs a pattern on the documents left. A pattern without mandatory trigrams runs on all.
The index is partitioned by document, so it moves nothing between tasks and a hot trigram costs no more than any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import product
from re import _constants as code, _parser as parser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import as_bytes, small_batches

EXACT_LIMIT = 64  # strings one part of a pattern may stand for before it counts as unknown
ANY = True


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its group `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False
    regex: re.Pattern = field(init=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "regex", re.compile(self.pattern, re.ASCII))

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.regex.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


# The three base rules.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
)
# Well-known token formats.
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login_url", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{4,64}@"),
    Rule("bearer", r"(?i:authorization)\x20*[:=]\x20*(?i:bearer)\x20+([A-Za-z0-9._~+/-]{16,}=*)"),
)
RULES = BASE_RULES + ADDED_RULES


def _both(a, b):
    return b if a is ANY else a if b is ANY else a if a == b else ("and", a, b)


def _either(a, b):
    return ANY if a is ANY or b is ANY else a if a == b else ("or", a, b)


def _contains(text: str):
    """The query that a lower-cased text with this string satisfies: all its trigrams of UTF-8 bytes."""
    raw, query = text.lower().encode("utf-8") if text.isascii() else text.encode("utf-8").lower(), ANY
    for i in range(len(raw) - 2):
        query = _both(query, raw[i:i + 3])
    return query


def _one_of(strings: set[str]):
    query = None
    for s in sorted(strings):
        query = _contains(s) if query is None else _either(query, _contains(s))
    return ANY if query is None else query


def _analyse(nodes) -> tuple[set[str] | None, object]:
    """For a sequence of parsed nodes: the strings it stands for (None: too many), and a query for it."""
    query, run, whole = ANY, {""}, True
    for node in nodes:
        exact, inner, ends = _node(node)
        if exact is not None and len(run) * len(exact) <= EXACT_LIMIT:
            run = {a + b for a, b in product(run, exact)}
        else:
            query, run, whole = _both(_both(query, _one_of(run)), inner), {""} if exact is None else exact, False
        if not ends:  # more of the same may follow
            query, run, whole = _both(query, _one_of(run)), {""}, False
    return (run, _one_of(run)) if whole else (None, _both(query, _one_of(run)))


def _node(node) -> tuple[set[str] | None, object, bool]:
    """(strings or None, query, whether the strings are all of the node)."""
    op, value = node
    if op is code.LITERAL:
        return {chr(value)}, ANY, True
    if op is code.IN:
        chars: set[str] = set()
        for kind, v in value:
            if kind is code.LITERAL:
                chars.add(chr(v))
            elif kind is code.RANGE and v[1] - v[0] < EXACT_LIMIT:
                chars.update(map(chr, range(v[0], v[1] + 1)))
            else:
                return None, ANY, True
        return (chars if len(chars) <= 8 else None), ANY, True
    if op is code.SUBPATTERN:
        return (*_analyse(value[3]), True)
    if op is code.BRANCH:
        strings: set[str] | None = set()
        query = None
        for branch in value[1]:
            exact, inner = _analyse(branch)
            strings = None if strings is None or exact is None else strings | exact
            query = inner if query is None else _either(query, inner)
        return (strings if strings and len(strings) <= EXACT_LIMIT else None), query, True
    if op in (code.MAX_REPEAT, code.MIN_REPEAT, code.POSSESSIVE_REPEAT):
        least, most, inside = value
        exact, inner = _analyse(inside)
        if least == 0:
            return (exact | {""}, ANY, True) if exact is not None and most == 1 else (None, ANY, True)
        if exact is None or len(exact) ** least > EXACT_LIMIT:
            return None, inner, True
        return {"".join(p) for p in product(exact, repeat=least)}, ANY, most == least
    if op is code.AT:
        return {""}, ANY, True
    return None, ANY, True


def trigram_query(pattern: str):
    """A Boolean query over trigrams that every text matching `pattern` satisfies once its A-Z are lower-cased:
    a trigram as bytes, ("and", a, b), ("or", a, b), or True where nothing is mandatory."""
    return _analyse(parser.parse(pattern, re.ASCII))[1]


def trigrams_of(query) -> set[bytes]:
    if query is ANY:
        return set()
    return {query} if isinstance(query, bytes) else trigrams_of(query[1]) | trigrams_of(query[2])


def candidates(query, postings: dict[bytes, np.ndarray], rows: int) -> np.ndarray:
    """The rows that satisfy a query, by intersecting and uniting sorted postings."""
    if query is ANY:
        return np.arange(rows)
    if isinstance(query, bytes):
        return postings.get(query, np.empty(0, np.int64))
    left = candidates(query[1], postings, rows)
    if query[0] == "and" and not len(left):
        return left
    right = candidates(query[2], postings, rows)
    return np.intersect1d(left, right, assume_unique=True) if query[0] == "and" else np.union1d(left, right)


class BlockIndex:
    """Postings of the named trigrams in one block of texts, found in one pass over its bytes."""

    def __init__(self, trigrams: set[bytes]) -> None:
        self.trigrams = sorted(trigrams)
        self.number = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(self.trigrams):
            self.number[int.from_bytes(t, "big")] = i + 1

    def postings(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        # Two line ends part the texts; matches over a border would need a trigram with a line end.
        data = np.frombuffer(b"\n\n".join(texts).lower() + b"\n\n", np.uint8)
        wide = data.astype(np.uint32)
        found = self.number[(wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]]
        at = np.flatnonzero(found)
        ends = np.cumsum([len(t) + 2 for t in texts])
        key = np.unique(found[at].astype(np.int64) * (len(texts) + 1) + np.searchsorted(ends, at, side="right"))
        number, row = key // (len(texts) + 1), key % (len(texts) + 1)
        cut = np.searchsorted(number, np.arange(1, len(self.trigrams) + 2))
        return {t: row[cut[i]:cut[i + 1]] for i, t in enumerate(self.trigrams)}


class Scanner:
    """All spans of all rules in a block of texts."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.index = BlockIndex(set().union(*map(trigrams_of, self.queries)))

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule number, end), in that order."""
        postings = self.index.postings(texts) if texts else {}
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        decoded: dict[int, str] = {}
        for k, (rule, query) in enumerate(zip(self.rules, self.queries)):
            for i in candidates(query, postings, len(texts)).tolist():
                if i not in decoded:
                    decoded[i] = texts[i].decode("utf-8", "surrogatepass")
                spans[i] += [(a, k, b) for a, b in rule.spans(decoded[i])]
        return [sorted(s) for s in spans]


def blocks(texts: list[bytes], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start = i
            size = 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document (doc_id, text): doc_id and `found`, an array of (kind, start, end) by start and then
    by the order of the rules. Positions count code points, the end is exclusive.

    A null text counts as empty and has no spans; a null doc_id stays null; repeated rows are scanned each. Other columns
    are ignored. Texts of any length are scanned whole.
    """
    kinds = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in small_batches(batches, 2048):
            texts = as_bytes(batch.column(1))
            found = [s for a, b in blocks(texts) for s in scanner.scan(texts[a:b])]
            rows = [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in s] for s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], names=["doc_id", "found"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(
        run, "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def secret_digest(found: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The counts and digests of `find_secrets`: n_<kind> of the base rules, base_sha256, spans, n_added."""
    base = [r.kind for r in rules if r.base]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(*kinds: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"].isin(*kinds))).cast("long")

    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(joined(F.filter("found", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        (F.size("found").cast("long") - count(*base)).alias("n_added"))


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span in `text` replaced by `mark`, overlapping spans by one, and `n_chars` counted anew where
    there is such a column. A null text stays null; all rows and all other columns are kept as they are."""

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(rules)
        for part in parts:
            texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in part]
            out: list[str | None] = []
            for a, b in blocks(texts):
                for text, spans in zip(part.iloc[a:b], scanner.scan(texts[a:b])):
                    pieces, at = [], 0
                    for start, _, end in spans:
                        if start >= at:
                            pieces += [text[at:start], mark]
                        at = max(at, end)
                    out.append("".join([*pieces, text[at:]]) if spans else text)
            yield pd.Series(out, index=part.index, dtype=object)

    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    fresh = clean("text")
    out = docs.withColumn("text", fresh)
    return out if kind is None else out.withColumn("n_chars", F.length("text").cast(kind))
