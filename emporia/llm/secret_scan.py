"""Secret scans with a trigram inverted index per shard and Boolean trigram queries derived from the rules.

A rule's regular expression yields the trigrams that every match must contain, as an AND of ORs of ANDs. A shard (a
run of documents inside one task) gets posting lists for the trigrams that the rules name; intersecting them leaves
the candidates, which the expression itself then verifies. Rules that force no trigram scan every document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser as sre

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import pick

#: Bytes of text that are indexed together, and the strings that one part of an expression may stand for.
SHARD_BYTES = 1 << 22
STRINGS = 48


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``least`` characters; a match that has fewer is passed over."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three kinds that the base report counts, in its order.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", r"\bgh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    # no start inside a run of its characters, so that a long run is read once
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\x00-\x20/:@]{1,}:[^\x00-\x20/:@]{3,}@"),
)

Query = list[list[frozenset[bytes]]]


def _strings(node, ignore_case: bool) -> list[str] | None:
    """The strings that a part of an expression can stand for, where they are few."""
    op, value = node
    if op is C.LITERAL:
        return [chr(value)]
    if op is C.IN:
        found: list[str] = []
        for kind, item in value:
            if kind is C.LITERAL:
                found.append(chr(item))
            elif kind is C.RANGE and item[1] - item[0] < STRINGS:
                found += map(chr, range(item[0], item[1] + 1))
            else:
                return None
        return found if len(found) <= 4 else None
    if op is C.BRANCH:
        made = [_joined(branch, ignore_case) for branch in value[1]]
        return None if any(m is None for m in made) else [s for m in made for s in m]
    if op is C.SUBPATTERN:
        return _joined(value[-1], ignore_case)
    if op is C.MAX_REPEAT:
        low, high, inside = value
        held = _joined(inside, ignore_case)
        if held is None or high is C.MAXREPEAT or int(high) > 2:
            return None
        return [s for n in range(low, int(high) + 1) for s in map("".join, product(held, repeat=n))]
    if op is C.AT:
        return [""]
    return None


def _joined(nodes, ignore_case: bool) -> list[str] | None:
    made = [""]
    for node in nodes:
        found = _strings(node, ignore_case)
        if found is None or len(made) * len(found) > STRINGS:
            return None
        made = [a + b for a in made for b in found]
    return made


def _runs(nodes) -> Iterator[list[str]]:
    """The strings of each longest run of parts that stand for few."""
    made = [""]
    for node in nodes:
        op, value = node
        found = _strings(node, False)
        if found is not None and len(made) * len(found) <= STRINGS:
            made = [a + b for a in made for b in found]
            continue
        yield made
        made = [""]
        if found is not None:
            made = found
        elif op is C.SUBPATTERN:
            yield from _runs(value[-1])
        elif op is C.MAX_REPEAT and value[0] >= 1:
            # at least one copy must be there; what stands beside it is unknown
            yield from _runs(value[2])
    yield made


def trigrams(text: str) -> frozenset[bytes]:
    """Trigrams of the bytes of a text with A-Z in lower case."""
    held = text.encode().lower()
    return frozenset(held[i : i + 3] for i in range(len(held) - 2))


def trigram_query(pattern: str) -> Query:
    """What every match contains: for each item, all trigrams of at least one of its strings. Empty: scan fully."""
    query = []
    for strings in _runs(sre.parse(pattern)):
        options = [trigrams(s) for s in strings]
        if options and all(options):
            query.append(list(dict.fromkeys(options)))
    return query


class Scanner:
    """The rules with their queries, and a table from trigrams to posting lists."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(r, re.compile(_bounded(r), re.ASCII), trigram_query(r.pattern)) for r in rules]
        named = sorted({t for _, _, q in self.rules for item in q for option in item for t in option})
        self.number = {t: i for i, t in enumerate(named)}
        self.table = np.full(1 << 24, -1, np.int16)
        for trigram, i in self.number.items():
            self.table[int.from_bytes(trigram, "big")] = i

    def postings(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each trigram that a rule names, the documents that contain it, in order."""
        joined = np.frombuffer(b"\0\0".join(texts) + b"\0\0", np.uint8).astype(np.int32)
        starts = np.cumsum([0] + [len(t) + 2 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
        codes = self.table[(joined[:-2] << 16) | (joined[1:-1] << 8) | joined[2:]]
        at = np.nonzero(codes >= 0)[0]
        docs = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(codes[at].astype(np.int64) * len(texts) + docs)
        cuts = np.searchsorted(pairs, np.arange(len(self.number) + 1) * len(texts))
        return [pairs[a:b] % len(texts) for a, b in zip(cuts, cuts[1:], strict=False)]

    def candidates(self, query: Query, postings: list[np.ndarray], docs: int) -> np.ndarray:
        left = np.arange(docs)
        for item in query:
            found = np.zeros(0, np.int64)
            for option in item:
                held = left
                for trigram in sorted(option, key=lambda t: len(postings[self.number[t]])):
                    held = np.intersect1d(held, postings[self.number[trigram]], assume_unique=True)
                found = np.union1d(found, held)
            left = found
        return left

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, number of the rule, end), in that order."""
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.postings([t.encode("utf-8", "surrogatepass").lower() for t in texts])
        for i, (rule, expression, query) in enumerate(self.rules):
            for doc in self.candidates(query, postings, len(texts)).tolist():
                for m in expression.finditer(texts[doc]):
                    if len(m[rule.group]) >= rule.least:
                        spans[doc].append((m.start(), i, m.end()))
        return [sorted(s) for s in spans]


def _bounded(rule: Rule) -> str:
    """One class repeated: shorter runs need not become matches first, as a longest run has the same start and end."""
    single = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{single[1]}{{{rule.least},}}" if single and not rule.group else rule.pattern


def _named(rules: list[Rule], spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{rules[i].kind}:{start}:{end}" for start, i, end in spans)


def secrets(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row, from its whole text.

    Matches of a kind are leftmost and do not overlap; those of different kinds may. ``spans`` lists all as
    ``kind:start:end`` in code points by start, then kind; ``base_sha256`` is the SHA-256 of the base kinds' list.
    Null counts as empty and has no spans. Repeated rows each appear, and an empty table gives no rows.
    """
    rules = BASE + more
    base = len(BASE)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(rules)

        def rows(texts: list[str]) -> Iterator[tuple]:
            for spans in scanner.scan(texts):
                own = [s for s in spans if s[1] < base]
                counts = [sum(s[1] == i for s in own) for i in range(base)]
                yield (*counts, hashlib.sha256(_named(rules, own).encode()).hexdigest(), _named(rules, spans))

        for batch in batches:
            out: list[tuple] = []
            shard: list[str] = []
            size = 0
            for text in batch:
                shard.append(text or "")
                size += len(shard[-1])
                if size >= SHARD_BYTES:
                    out += rows(shard)
                    shard, size = [], 0
            if shard:
                out += rows(shard)
            yield pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    found = pick(docs, "doc_id", "text").select("doc_id", report("text").alias("r"))
    return found.select("doc_id", "r.n_assign", "r.n_access", "r.n_hex", "r.base_sha256", "r.spans")
