"""Personal data by weak supervision.

Patterns, and a gazetteer of names, propose candidate spans. Labelers (format, checksum, gazetteer, cue words
before, borders) vote yes, no or nothing on each. How often each combination of kind, votes and features
occurs is counted over all documents; the number of combinations is bounded by the labelers and features, not
by the data. From these counts, expectation-maximisation estimates how reliable each labeler is, and the resulting
soft labels train a logistic span classifier. It sees the votes and features of its own: length, share of digits
and separators of the span, and per kind a hash class of the word before it, so it learns contexts that no
labeler lists. Candidates that it scores at `accept` or more are taken; spans of the base kinds (email, ip, card,
phone) always. detect() finds the candidates once; fit() and find_personal_data() apply a model to other documents.

The gazetteer is a parameter (names_of() reads it from a table); the one given here is a short list of common names.

Nulls: a null text is empty and has no spans. Repeated rows count as often as they occur and get
repeated results. Empty tables work: an untrained classifier accepts base kinds only. Columns of the
input with the names this makes are replaced.
"""

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import map_rows, others, small_batches
from tickertide.llm.secret_scan import code_points
from tickertide.sources.handover import materialise

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "local_phone", "national_id", "iban", "person", "birth_date")
MADE = "spans array<struct<kind: string, start: long, end: long, score: double>>, clean_text string"

_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can begin only where a run of digits begins: what follows the run is the same from inside it
_IP = re.compile(rb"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
# shorter chains of digits are dropped anyway
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_EXTRA = {
    "local_phone": re.compile(rb"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9-])"),
    "national_id": re.compile(rb"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"),
    "person": re.compile(rb"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Mlle|Sr|Sra)\.? [A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?"),
    "birth_date": re.compile(rb"(?<![0-9./-])(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9-])"),
}
#: Words that speak for a kind when they stand shortly before a span, and words that speak against any.
CUES = {
    "email": (b"mail", b"contact", b"write"), "ip": (b"ip", b"host", b"server", b"address"), "card": (b"card", b"visa", b"credit", b"pay"),
    "phone": (b"phone", b"tel", b"call", b"mobile", b"fax"), "local_phone": (b"phone", b"tel", b"call", b"mobile", b"fax"),
    "national_id": (b"ssn", b"social", b"id"), "iban": (b"iban", b"account", b"bank", b"konto"), "person": (b"name", b"dear", b"by", b"from", b"with"),
    "birth_date": (b"born", b"birth", b"dob", b"naissance", b"geboren"),
}
AGAINST = (b"version", b"order", b"ticket", b"isbn", b"invoice", b"build", b"chapter")
#: Gazetteers: mail domains' ends, country calling codes, IBAN countries, common given and family names.
ENDS = {b"com", b"org", b"net", b"edu", b"gov", b"de", b"fr", b"es", b"uk", b"eu", b"io", b"info"}
CALLING = (b"1", b"33", b"34", b"44", b"49", b"39", b"41", b"43", b"31", b"32", b"52", b"81", b"86", b"91", b"61")
IBAN_LENGTHS = {b"DE": 22, b"FR": 27, b"ES": 24, b"GB": 22, b"IT": 27, b"NL": 18, b"BE": 16, b"AT": 20, b"CH": 21}


@dataclass(frozen=True)
class Names:
    """Given names begin a person's span; both kinds vote for one."""

    given: frozenset[bytes]
    family: frozenset[bytes]


#: Common given and family names of English, German, French, Spanish and Italian.
NAMES = Names(
    frozenset(b"""
Adam Alan Alexander Alice Amy Andrea Andrew Angela Anna Anne Anthony Antonio Barbara Benjamin Brian Carlos Carmen Catherine
Charles Christian Christine Claire Claudia Daniel David Diana Edward Elena Elizabeth Emily Emma Eric Eva Francisco Frank
Franz George Giovanni Hans Helen Henry Isabel Jack Jacques James Jane Jean Jennifer Jessica Joan John Jonathan Jose Joseph
Juan Julia Karen Karl Katharina Kevin Laura Linda Louis Lucia Luis Manuel Marco Margaret Maria Marie Mark Martha Mary
Matthew Michael Michel Miguel Nancy Nicolas Olivia Patricia Patrick Paul Pedro Peter Philippe Pierre Rachel Richard Robert
Sandra Sarah Sofia Stefan Stephen Susan Susanne Thomas Victoria Walter William Wolfgang
""".split()),
    frozenset(b"""
Anderson Bauer Becker Bernard Bianchi Brown Clark Colombo Davis Diaz Dubois Durand Evans Fernandez Ferrari Fischer Garcia
Gomez Gonzalez Green Harris Hernandez Hoffmann Jackson Johnson Jones Klein Lambert Laurent Lefebvre Lewis Lopez Martin
Martinez Meyer Miller Moore Moreau Muller Perez Petit Ramirez Richter Rivera Robinson Rodriguez Romano Rossi Roux Russo Sanchez
Schmidt Schneider Schulz Simon Smith Taylor Thompson Torres Wagner Walker Weber White Williams Wilson Wolf Wright Young
""".split()),
)
_CHAIN = re.compile(rb"(?<![A-Za-z])([A-Z][a-z]{1,20})(?=((?: [A-Z][a-z]{1,20}){1,3})(?![A-Za-z]))")


def names_of(table: DataFrame, most: int = 500_000) -> Names:
    """A gazetteer from a table (name, kind: given or family) of at most `most` rows; it goes to every task."""
    rows = table.select("name", "kind").filter("name is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the gazetteer has more than {most} names")
    return Names(*(frozenset(r["name"].encode() for r in rows if r["kind"] == kind) for kind in ("given", "family")))


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(value: bytes) -> bytes:
    return bytes(c for c in value if 48 <= c <= 57)


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find(b"@", max(at + 1, end))


def _persons(text: bytes, names: Names) -> Iterator[tuple[int, int]]:
    """Names after a title, and elsewhere a given name of the gazetteer with the one to three capitalised words after it."""
    titled = [m.span() for m in _EXTRA["person"].finditer(text)]
    yield from titled
    starts, end = [a for a, _ in titled], 0
    for m in _CHAIN.finditer(text):
        if m[1] not in names.given or m.start() < end:
            continue
        before = bisect.bisect_right(starts, m.start()) - 1
        if before < 0 or titled[before][1] <= m.start():
            end = m.end(2)
            yield m.start(), end


def candidates(text: bytes, names: Names = NAMES) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) in bytes; base kinds as defined, the others wherever their pattern or a name stands."""
    for a, b in _emails(text):
        yield a, b, "email"
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or b"0") <= 255 for p in (part.lstrip(b"0") for part in m[0].split(b"."))):
            yield m.start(), m.end(), "ip"
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) <= 19 and luhn(digits):
            yield m.start(), m.end(), "card"
    if b"+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield m.start(), m.end(), "phone"
    for a, b in _persons(text, names):
        yield a, b, "person"
    for kind, pattern in _EXTRA.items():
        if kind != "person":
            for m in pattern.finditer(text):
                yield m.start(), m.end(), kind


# --- labelers: 1 yes, 0 no, 2 nothing ---


def _format(kind: str, value: bytes, before: bytes, after: bytes, names: Names) -> int:
    if kind == "email":
        return int(value.rpartition(b".")[2].isalpha() and b".." not in value)
    if kind == "ip":
        return int(all(p == b"0" or not p.startswith(b"0") for p in value.split(b".")))
    if kind == "card":
        return int(value[:1] in b"3456" and len({value[i : i + 1] for i in range(len(value)) if value[i : i + 1] in b" -"}) <= 1)
    if kind in ("phone", "local_phone"):
        return int(value.count(b"(") == value.count(b")") <= 1 and b"  " not in value)
    if kind == "national_id":
        return int(value[:3] not in (b"000", b"666") and value[:1] != b"9" and value[4:6] != b"00")
    if kind == "birth_date":
        return int(b"01" <= value[5:7] <= b"12" and b"01" <= value[8:] <= b"31")
    return 2


def _checksum(kind: str, value: bytes, before: bytes, after: bytes, names: Names) -> int:
    if kind == "card":
        return 1
    if kind == "iban":
        moved = value[4:] + value[:4]
        return int(int("".join(str(int(chr(c), 36)) for c in moved)) % 97 == 1)
    return 2


def _gazetteer(kind: str, value: bytes, before: bytes, after: bytes, names: Names) -> int:
    if kind == "email":
        return 1 if value.rpartition(b".")[2].lower() in ENDS else 2
    if kind == "phone":
        return 1 if value[1:].startswith(CALLING) else 0
    if kind == "iban":
        return int(IBAN_LENGTHS.get(value[:2]) == len(value)) if value[:2] in IBAN_LENGTHS else 2
    if kind == "person":
        words = set(value.split())
        return 1 if not words.isdisjoint(names.given) or not words.isdisjoint(names.family) else 2
    return 2


def _cues(kind: str, value: bytes, before: bytes, after: bytes, names: Names) -> int:
    words = re.findall(rb"[a-z]+", before.lower())
    if any(w in AGAINST for w in words):
        return 0
    return 1 if any(w in CUES[kind] for w in words) else 2


def _borders(kind: str, value: bytes, before: bytes, after: bytes, names: Names) -> int:
    return int(not (before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in (b"/", b"=", b"_") and before))


LABELERS = (_format, _checksum, _gazetteer, _cues, _borders)
SHAPES, SHARES, GAPS, CONTEXTS = 3, 4, 3, 17
_LAST_WORD = re.compile(rb"([A-Za-z]+)[^A-Za-z]*\Z")


def features_of(value: bytes, before: bytes) -> tuple[int, int, int]:
    """Share of digits (none, fewer than half, half or more, all), kinds of separators (0 to 2), class of the word before (0: none)."""
    digits = len(_digits(value))
    share = 0 if not digits else 3 if digits == len(value) else 1 + (2 * digits >= len(value))
    gaps = min(GAPS - 1, len({c for c in value if c in b" .-()/"}))
    word = _LAST_WORD.search(before)
    return share, gaps, 1 + zlib.crc32(word[1].lower()) % (CONTEXTS - 1) if word else 0


def pattern_of(kind: str, value: bytes, before: bytes, after: bytes, names: Names = NAMES) -> tuple[int, ...]:
    """(kind, shape, vote of each labeler, features of the span) as small numbers; shape: short, middle or long."""
    shape = 0 if len(value) < 12 else 1 if len(value) < 24 else 2
    votes = (label(kind, value, before, after, names) for label in LABELERS)
    return (KINDS.index(kind), shape, *votes, *features_of(value, before))


def found_in(text: bytes, names: Names = NAMES) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """Candidates with their patterns, by start, then as the kinds are listed."""
    rows = sorted((a, KINDS.index(kind), b) for a, b, kind in candidates(text, names))
    return [(a, b, KINDS[k], pattern_of(KINDS[k], text[a:b], text[max(0, a - 40) : a], text[b : b + 10], names)) for a, k, b in rows]


# --- fitting ---


def expectation_maximisation(patterns: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Probability that a candidate of each pattern is right, and each labeler's P(vote | wrong, right)."""
    kinds, votes = patterns[:, 0], patterns[:, 2 : 2 + len(LABELERS)]
    yes, no = (votes == 1).sum(1), (votes == 0).sum(1)
    right = (yes + 1.0) / (yes + no + 2.0)
    table = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([(1 - right) * n, right * n])
        for j in range(votes.shape[1]):
            for v in range(3):
                table[j, :, v] = weight[:, votes[:, j] == v].sum(1) + 1
            table[j] /= table[j].sum(1, keepdims=True)
        prior = np.array([(weight[1][kinds == k].sum() + 1) / (weight[:, kinds == k].sum() + 2) for k in range(len(KINDS))])
        odds = np.log(prior / (1 - prior))[kinds]
        for j in range(votes.shape[1]):
            odds = odds + np.log(table[j, 1, votes[:, j]] / table[j, 0, votes[:, j]])
        new = 1 / (1 + np.exp(-odds.clip(-30, 30)))
        if np.abs(new - right).max() < 1e-9:
            break
        right = new
    return right, table


def _features(patterns: np.ndarray) -> np.ndarray:
    """Indicators of the votes and features; patterns without features have those numbered 0."""
    votes_end = 2 + len(LABELERS)
    patterns = np.pad(patterns, ((0, 0), (0, max(0, votes_end + 3 - patterns.shape[1]))))
    kinds = [patterns[:, 0] == k for k in range(len(KINDS))]
    columns = kinds + [patterns[:, 1] == s for s in range(SHAPES)]
    columns += [patterns[:, 2 + j] == v for j in range(len(LABELERS)) for v in range(3)]
    columns += [patterns[:, votes_end] == v for v in range(SHARES)] + [patterns[:, votes_end + 1] == v for v in range(GAPS)]
    columns += [k & (patterns[:, votes_end + 2] == c) for k in kinds for c in range(CONTEXTS)]
    return np.stack(columns, axis=1).astype(float)


@dataclass
class Model:
    """Weights of the span classifier; reliabilities as the fitting left them."""

    weights: np.ndarray | None = None
    reliabilities: np.ndarray | None = None
    names: Names = NAMES

    def scores(self, patterns: list[tuple[int, ...]]) -> list[float]:
        if self.weights is None or not patterns:
            return [float(p[0] < len(BASE)) for p in patterns]
        return (1 / (1 + np.exp(-(_features(np.array(patterns)) @ self.weights).clip(-30, 30)))).tolist()


def train(patterns: np.ndarray, n: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> Model:
    """Soft labels by EM, then logistic regression on them by Newton's method."""
    if not len(patterns):
        return Model()
    right, table = expectation_maximisation(patterns, n)
    x = _features(patterns)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        slope = x.T @ (n * (right - p)) - penalty * w
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return Model(w, table)


def count_patterns(docs: DataFrame, names: Names = NAMES) -> DataFrame:
    """(pattern, n) over all documents: the number of rows is bounded by labelers and features, not by the documents."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            counts: dict[str, int] = {}
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for *_, pattern in found_in(text or b"", names):
                    key = ",".join(map(str, pattern))
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def _trained(counted: DataFrame) -> Model:
    rows = sorted((tuple(map(int, r["pattern"].split(","))), r["n"]) for r in counted.collect())
    return train(np.array([p for p, _ in rows], dtype=int), np.array([n for _, n in rows], dtype=float))


def fit(docs: DataFrame, names: Names = NAMES) -> Model:
    model = _trained(count_patterns(docs, names))
    return Model(model.weights, model.reliabilities, names)


def masked(text: bytes, spans: list[tuple[int, int, str]]) -> bytes:
    """Each span, or run of overlapping spans, becomes its first kind's name in angle brackets."""
    pieces, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            pieces += [text[at:a], b"<" + kind.upper().encode() + b">"]
        at = max(at, b)
    return b"".join([*pieces, text[at:]])


def find_personal_data(
    docs: DataFrame, model: Model, accept: float = 0.5, with_text: bool = True, keep: list[str] | None = None
) -> DataFrame:
    """docs with spans (code points, end exclusive, by start then kind) and clean_text, the masked text (null unless with_text)."""

    def work(given):
        found = [found_in(t or b"", model.names) for t in given["text"]]
        scores = iter(model.scores([c[3] for f in found for c in f]))
        spans, texts = [], []
        for text, rows in zip(given["text"], found, strict=True):
            scored = [(a, b, kind, s) for (a, b, kind, _), s in zip(rows, scores, strict=False)] if rows else []
            taken = [c for c in scored if c[2] in BASE or c[3] >= accept]
            starts, ends = code_points(text, [t[0] for t in taken]), code_points(text, [t[1] for t in taken])
            spans.append([{"kind": kind, "start": a, "end": b, "score": s} for (_, _, kind, s), a, b in zip(taken, starts, ends)])
            texts.append(masked(text, [c[:3] for c in taken]).decode("utf-8", "replace") if with_text and text is not None else None)
        return {"spans": spans, "clean_text": texts}

    given = docs.withColumn("text", F.col("text").cast("string"))
    return map_rows(given, MADE, work, {"text": "bytes"}, keep)


_SPOTTED = "_pii_candidates array<struct<kind: string, start: long, end: long, pattern: array<int>>>"


def detect(docs: DataFrame, accept: float = 0.5, names: Names = NAMES, keep: list[str] | None = None) -> DataFrame:
    """docs (or the columns `keep` of it) with spans, by a model fitted on the same documents; texts are read once.

    The candidates, few against the text, are written with the kept columns; counts and verdicts come from them.
    """

    def spot(given):
        rows = []
        for text in given["text"]:
            found = found_in(text or b"", names)
            starts, ends = code_points(text, [c[0] for c in found]), code_points(text, [c[1] for c in found])
            rows.append([{"kind": c[2], "start": a, "end": b, "pattern": list(c[3])} for c, a, b in zip(found, starts, ends)])
        return {"_pii_candidates": rows}

    given = docs.withColumn("text", F.col("text").cast("string"))
    kept = others(given, ["spans"]) if keep is None else keep
    spotted = materialise(map_rows(given, _SPOTTED, spot, {"text": "bytes"}, kept), "pii-candidates")
    patterns = spotted.select(F.explode("_pii_candidates.pattern").alias("p"))
    counted = patterns.groupBy(F.concat_ws(",", F.transform("p", lambda x: x.cast("string"))).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    model = _trained(counted)

    def judge(given):
        scores = iter(model.scores([tuple(c["pattern"]) for row in given["_pii_candidates"] for c in row]))
        judged = [[{"kind": c["kind"], "start": c["start"], "end": c["end"], "score": next(scores)} for c in row] for row in given["_pii_candidates"]]
        return {"spans": [[c for c in row if c["kind"] in BASE or c["score"] >= accept] for row in judged]}

    return map_rows(spotted, MADE.split(", clean_text")[0], judge, {"_pii_candidates": "as is"}, [c for c in spotted.columns if c != "_pii_candidates"])
