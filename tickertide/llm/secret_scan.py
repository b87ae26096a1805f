"""Secret scans with a trigram inverted index.

Each rule's pattern is turned into a Boolean query over trigrams that every match must hold. The
documents of an Arrow batch form a segment with its own inverted index (trigram -> sorted documents)
of the trigrams the rules ask for; postings are intersected and united as the query says, and the
pattern is run over the whole texts of the candidates only. Rules without mandatory trigrams
run over all texts. Segments need no shuffle and have a bounded size.

Nulls: a null text is empty and has no spans. Repeated rows give repeated results; empty tables give
empty results. Columns of the input with the names this makes are replaced.
"""

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as K
from re import _parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import _FOLD, joined, map_rows

MADE = "spans array<struct<kind: string, start: long, end: long>>"


def _always(match: re.Match) -> bool:
    return True


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    check: Callable[[re.Match], bool] = _always


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _long_value(match: re.Match) -> bool:
    return len(match[2]) >= 6


_NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
#: The first three are always run; a run of hex digits below 24 is no match of the last one's shorter form.
BASE = (
    Rule("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", _long_value),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("api_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z]{2,10}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)

# --- Boolean queries: True (nothing is mandatory), bytes (a trigram), ("and" | "or", parts) ---

MOST = 64


def _both(a, b):
    return b if a is True else a if b is True or a == b else ("and", (a, b))


def _any(parts: list):
    unique = list(dict.fromkeys(parts))
    return True if True in unique else unique[0] if len(unique) == 1 else ("or", tuple(unique))


def _trigrams(strings: set[bytes]):
    """Each match holds one of the strings."""

    def of(s: bytes):
        grams = list(dict.fromkeys(s[i : i + 3] for i in range(len(s) - 2)))
        return grams[0] if len(grams) == 1 else ("and", tuple(grams)) if grams else True

    return _any([of(s) for s in sorted(strings)])


def _characters(items) -> set[bytes] | None:
    found = set()
    for op, value in items:
        if op is K.LITERAL:
            found.add(chr(value).lower().encode())
        elif op is K.RANGE and value[1] - value[0] < 4:
            found |= {chr(c).lower().encode() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 4 else None


def _analyse(tree) -> tuple[set[bytes] | None, object]:
    """(the exact strings that a part can match, or None; its query besides those strings)."""
    run, exact, query = {b""}, True, True
    for op, value in tree:
        strings, more = _analyse_one(op, value)
        query = _both(query, more)
        if strings is not None and len(run) * len(strings) <= MOST:
            run = {a + b for a in run for b in strings}
            continue
        query, exact = _both(query, _trigrams(run)), False
        run = strings if strings is not None else {b""}
    return (run, query) if exact else (None, _both(query, _trigrams(run)))


def _analyse_one(op, value) -> tuple[set[bytes] | None, object]:
    if op is K.LITERAL:
        return {chr(value).lower().encode()}, True
    if op is K.IN:
        return _characters(value), True
    if op is K.SUBPATTERN:
        return _analyse(value[-1])
    if op is K.BRANCH:
        parts = [_analyse(part) for part in value[1]]
        if all(s is not None and q is True for s, q in parts) and len(united := set().union(*(s for s, _ in parts))) <= MOST:
            return united, True
        return None, _any([_both(q, True if s is None else _trigrams(s)) for s, q in parts])
    if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, query = _analyse(inner)
        if least == 0:
            return (strings | {b""}, True) if most == 1 and strings is not None and query is True else (None, True)
        if least == most == 1:
            return strings, query
        return None, _both(query, True if strings is None else _trigrams(strings))
    return (set([b""]), True) if op in (K.AT, K.ASSERT, K.ASSERT_NOT) else (None, True)


def trigram_query(pattern: str):
    """The Boolean query over lower-case trigrams that every match of the pattern fulfils."""
    strings, query = _analyse(_parser.parse(pattern))
    return _both(query, True if strings is None else _trigrams(strings))


def trigrams_in(query) -> set[bytes]:
    return set() if query is True else {query} if isinstance(query, bytes) else set().union(*map(trigrams_in, query[1]))


def _code(gram: bytes) -> int:
    return gram[0] << 16 | gram[1] << 8 | gram[2]


class Segment:
    """Inverted index of some texts for the trigrams that are asked for."""

    def __init__(self, texts: list[bytes | None], wanted: np.ndarray):
        buffer, offsets = joined(texts)
        self.documents = np.arange(len(texts))
        low = _FOLD[np.frombuffer(buffer, dtype=np.uint8)].astype(np.int32)
        codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.zeros(0, dtype=np.int32)
        at = np.flatnonzero(wanted[codes])
        holder = np.searchsorted(offsets, at, "right") - 1
        pairs = np.unique(codes[at].astype(np.int64) * len(texts) + holder) if len(at) else np.zeros(0, dtype=np.int64)
        grams, self.holders = np.divmod(pairs, max(1, len(texts)))
        names, begins = np.unique(grams, return_index=True)
        ends = [*begins[1:].tolist(), len(pairs)][: len(names)]
        self.postings = {g: (b, e) for g, b, e in zip(names.tolist(), begins.tolist(), ends, strict=True)}

    def posting(self, gram: bytes) -> np.ndarray:
        begin, end = self.postings.get(_code(gram), (0, 0))
        return self.holders[begin:end]

    def search(self, query) -> np.ndarray:
        if query is True:
            return self.documents
        if isinstance(query, bytes):
            return self.posting(query)
        found = [self.search(part) for part in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(found))
        out = found[0]
        for other in found[1:]:
            out = np.intersect1d(out, other, assume_unique=True)
        return out


def scanner(rules: tuple[Rule, ...]) -> Callable[[dict[str, list]], dict[str, list]]:
    compiled: list = []

    def work(given):
        if not compiled:
            queries = [trigram_query(r.pattern) for r in rules]
            wanted = np.zeros(1 << 24, dtype=bool)
            for gram in set().union(*map(trigrams_in, queries)):
                wanted[_code(gram)] = True
            compiled[:] = [wanted, [(k, r, re.compile(r.pattern.encode()), q) for k, (r, q) in enumerate(zip(rules, queries, strict=True))]]
        wanted, parts = compiled
        texts = given["text"]
        segment = Segment(texts, wanted)
        spans: list[list] = [[] for _ in texts]
        for k, rule, pattern, query in parts:
            for d in segment.search(query).tolist():
                for m in pattern.finditer(texts[d] or b""):
                    if rule.check(m):
                        spans[d].append((m.start(), k, m.end()))
        out = []
        for text, found in zip(texts, spans, strict=True):
            found.sort()
            starts, ends = code_points(text, [a for a, _, _ in found]), code_points(text, [b for _, _, b in found])
            out.append([{"kind": rules[k].kind, "start": a, "end": b} for (_, k, _), a, b in zip(found, starts, ends)])
        return {"spans": out}

    return work


def code_points(text: bytes | None, places: list[int]) -> list[int]:
    """Characters before each of some bytes of a text in UTF-8, in one pass over the text."""
    if not places or text.isascii():
        return places
    before = np.zeros(len(text) + 1, dtype=np.int64)
    np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, out=before[1:])
    return before[places].tolist()


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, keep: list[str] | None = None) -> DataFrame:
    """docs with spans: kind, start and end (code points, end exclusive), by start, then as the rules are listed."""
    given = docs.withColumn("text", F.col("text").cast("string"))
    return map_rows(given, MADE, scanner(rules), {"text": "bytes"}, keep)
