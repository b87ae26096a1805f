"""Periodic runs of words: stretches that repeat a period of q words at least three times.

A run is a maximal stretch of consecutive words with smallest period q that is at least `least_words` and
`least_exponent` * q words long. Found with enhanced suffix arrays (Abouelhoda, Kurtz, Ohlebusch 2004) by the
branching-tandem test (Stoye, Gusfield 2002), many texts at a time in each task:

1. Words become numbers that no two texts share, so all texts of a batch share one suffix array and no common
   prefix leaves a text. Ranks by the first 1, 2, 4, ... words come from doubling; a text in which no 16 words
   occur twice has no run (words q apart agree for at least 16 words in each) and needs no more.
2. The array SA, its inverse ISA and the common prefixes LCP of neighbours give the LCP intervals bottom-up from a
   stack of open ones; there are no tree nodes. For an interval of depth d, each suffix i of all but its largest
   child is tested: if ISA[i+d], or ISA[i-d], lies in the interval but in another child, a square of two times d
   words starts at i, or at i-d, and the next word breaks it. Each suffix is in a smaller child O(log n) times.
3. Such a square is the last of its run. Rotating it to the left, word by word, finds where the run starts.
   Squares by ascending d: one that ends with a run of a divisor of d, inside that run, is the same stretch.

Memory is bounded by a batch of texts (BATCH_BYTES) or one text, whichever is larger; nothing is shuffled.
A word is dropped if a run holds it after that run's first q words.

Null text: no words, no runs, collapsed text empty. Empty and very long texts, repeated rows and empty tables work; equal
exponents go to the smaller start, then the smaller period. Columns of the input with the names this makes are replaced.
"""

import numpy as np
from pyspark.sql import DataFrame

from tickertide.llm.common import map_rows

MADE = (
    "n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "best struct<start:long,length:long,period:long>, collapsed string"
)
#: Words that any two places q apart in a run have in common: 24 - 8, or twice a period above 8.
SHARED = 16
#: Expanded suffix tests at a time.
TESTS = 1 << 20


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers that differ between texts, and where each text ends (per word)."""
    names, out, ends, at = {}, [], [], 0
    for words in texts:
        names.clear()
        out.append(np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words)) + at)
        at += len(words)
        ends.append(np.full(len(words), at, np.int64))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(ends)


def _ranked(keys: np.ndarray, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Give the places new ranks by (rank, key): a rank is the number of smaller suffixes. Returns those still shared."""
    # ranks and keys are at most the number of words
    both = rank[places] * (len(rank) + 1) + keys
    order = np.argsort(both)
    places, both = places[order], both[order]
    old = rank[places]
    heads = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
    sizes = np.diff(np.append(heads, len(places)))
    # a group keeps its old rank plus the members that are smaller
    new_old = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
    base = new_old[np.searchsorted(new_old, heads, side="right") - 1]
    rank[places] = np.repeat(old[heads] + heads - base, sizes)
    return places[np.repeat(sizes > 1, sizes)]


def _level(rank: np.ndarray, ends: np.ndarray, active: np.ndarray, h: int) -> np.ndarray:
    """Refine ranks by h words to ranks by 2h words."""
    later = active + h
    inside = later < ends[active]
    keys = np.where(inside, rank[np.where(inside, later, 0)] + 1, 0)
    return _ranked(keys, rank, active)


def _first(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rank = np.zeros(len(words), dtype=np.int64)
    return rank, _ranked(words, rank, np.arange(len(words)))


def may_repeat(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per word: is it in a text in which SHARED words occur twice?"""
    rank, active = _first(words)
    h = 1
    while h < SHARED and len(active):
        active = _level(rank, ends, active, h)
        h *= 2
    return np.isin(ends, np.unique(ends[active]))


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """SA, ISA and LCP (LCP[r] of the suffixes at r - 1 and r); suffixes end with their text."""
    rank, active = _first(words)
    levels, h = [], 1
    while len(active):
        levels.append(rank.astype(np.int32 if len(words) < 1 << 31 else np.int64))
        active = _level(rank, ends, active, h)
        h *= 2
    sa = np.empty(len(words), dtype=np.int64)
    sa[rank] = np.arange(len(words))
    lcp = np.zeros(len(words), dtype=np.int64)
    a, b = sa[:-1].copy(), sa[1:].copy()
    stop_a, stop_b = ends[a], ends[b]
    for k in range(len(levels) - 1, -1, -1):
        level, h = levels.pop(), 1 << k
        # equal ranks mean h equal words, if both suffixes are that long
        live = np.flatnonzero((a + h <= stop_a) & (b + h <= stop_b))
        live = live[level[a[live]] == level[b[live]]]
        a[live] += h
        b[live] += h
        lcp[live + 1] += h
    return sa, rank, lcp


def smaller_children(lcp: np.ndarray):
    """(lb, rb, depth, child lb, child rb) of all but the largest child of each LCP interval, from a stack of open intervals."""
    values = lcp.tolist() + [0]
    depths, borders = [0], [[0]]
    for r in range(1, len(values)):
        depth = values[r]
        if depth > depths[-1]:
            depths.append(depth)
            borders.append([r - 1, r])
            continue
        while depth < depths[-1]:
            d, cuts = depths.pop(), borders.pop()
            cuts.append(r)
            largest = max(range(len(cuts) - 1), key=lambda k: cuts[k + 1] - cuts[k])
            for k in range(len(cuts) - 1):
                if k != largest:
                    yield cuts[0], r - 1, d, cuts[k], cuts[k + 1] - 1
            if depth > depths[-1]:
                # the closed interval is the first child of a new one
                depths.append(depth)
                borders.append([cuts[0], r])
                break
        else:
            if depths[-1] == depth and depth:
                borders[-1].append(r)


def _tested(tests: list, sa: np.ndarray, isa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lb, rb, d, child, child_end = np.array(tests, dtype=np.int64).T
    sizes = child_end - child + 1
    row = np.repeat(np.arange(len(tests)), sizes)
    r = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + child[row]
    i, d, lb, rb, child, child_end = sa[r], d[row], lb[row], rb[row], child[row], child_end[row]
    starts, periods = [], []
    for other, start in ((i + d, i), (i - d, i - d)):
        ok = (other >= 0) & (other < len(sa))
        at = isa[np.where(ok, other, 0)]
        ok &= (at >= lb) & (at <= rb) & ((at < child) | (at > child_end))
        starts.append(start[ok])
        periods.append(d[ok])
    return np.concatenate(starts), np.concatenate(periods)


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of each square that the next word breaks, by ascending period."""
    found, tests, size = [], [], 0
    for test in smaller_children(lcp):
        tests.append(test)
        size += test[4] - test[3] + 1
        if size >= TESTS:
            found.append(_tested(tests, sa, isa))
            tests, size = [], 0
    if tests:
        found.append(_tested(tests, sa, isa))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate([f[1] for f in found]), np.concatenate([f[0] for f in found])]), axis=1)
    return pairs[1], pairs[0]


def _rotated(words: np.ndarray, text_start: int, i: int, d: int) -> int:
    """How far the square at i rotates to the left inside its text."""
    far, step = i, 16
    while far > text_start:
        low = max(text_start, far - step)
        same = words[low:far] == words[low + d : far + d]
        if not same.all():
            return i - (low + int(np.flatnonzero(~same)[-1]) + 1)
        far, step = low, step * 2
    return i - far


def find_runs(words: np.ndarray, ends: np.ndarray, least_words: int, least_exponent: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs by text (named by its end): (place of the start, length, period)."""
    if not len(words):
        return {}
    sa, isa, lcp = suffix_array(words, ends)
    starts, periods = branching_squares(sa, isa, lcp)
    text_starts = np.concatenate(([0], np.unique(ends)))
    begin = text_starts[np.searchsorted(text_starts, starts, side="right") - 1]
    # rotate all squares by as many words as any run needs, at most SHARED - 1; few are left
    need = np.maximum(np.maximum(least_words, least_exponent * periods) - 2 * periods, 0)
    live = np.arange(len(starts))
    live = live[starts - need >= begin]
    for k in range(1, SHARED):
        asks = need[live] >= k
        at = starts[live] - k
        live = live[~asks | (words[np.maximum(at, 0)] == words[np.maximum(at, 0) + periods[live]])]
    seen: dict[int, list[tuple[int, int]]] = {}
    out: dict[int, list[tuple[int, int, int]]] = {}
    for i, d, low in zip(starts[live].tolist(), periods[live].tolist(), begin[live].tolist()):
        end = i + 2 * d
        if any(d % q == 0 and start <= i for q, start in seen.get(end, ())):
            continue
        start = i - _rotated(words, low, i, d)
        # shorter squares of a period are kept too: their multiples are no smallest periods
        seen.setdefault(end, []).append((d, start))
        if end - start >= max(least_words, least_exponent * d):
            out.setdefault(int(ends[i]), []).append((start, end - start, d))
    return out


def _parts(texts: list[list[bytes]], most: int) -> list[list[int]]:
    """Texts that are worked on together: up to `most` words, or one longer text."""
    parts, size = [[]], 0
    for k, words in enumerate(texts):
        if parts[-1] and size + len(words) > most:
            parts.append([])
            size = 0
        parts[-1].append(k)
        size += len(words)
    return parts


def runs_of_texts(texts: list[list[bytes]], least_words: int = 24, least_exponent: int = 3, most: int = 1 << 18) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start, then period."""
    out: list[list] = [[] for _ in texts]
    for part in _parts(texts, most):
        words, ends = numbered([texts[k] for k in part])
        stays = may_repeat(words, ends) if len(words) else np.zeros(0, dtype=bool)
        if not stays.any():
            continue
        # only texts that repeat something go on; their places move together
        lengths = np.array([len(texts[k]) for k in part])
        kept = [k for k, end, n in zip(part, np.cumsum(lengths).tolist(), lengths.tolist()) if n and stays[end - 1]]
        words = words[stays]
        tops = np.cumsum([len(texts[k]) for k in kept])
        ends = np.repeat(tops, [len(texts[k]) for k in kept])
        by_end = dict(zip(tops.tolist(), kept))
        for end, runs in find_runs(words, ends, least_words, least_exponent).items():
            low = end - len(texts[by_end[end]])
            out[by_end[end]] = sorted(((s - low, n, q) for s, n, q in runs), key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words no run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()])


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def detect_runs(docs: DataFrame, least_words: int = 24, least_exponent: int = 3, keep: list[str] | None = None) -> DataFrame:
    """docs with n_words, runs (by start, then period), best (the run with the most repetitions) and collapsed (the text without them)."""
    if least_exponent < 3 or least_words < 3 * SHARED // 2:
        raise ValueError(f"runs have at least three periods and {3 * SHARED // 2} words")
    names = ("start", "length", "period")

    def work(given):
        # splits bytes at ASCII white space
        texts = [(t or b"").split() for t in given["text"]]
        runs = runs_of_texts(texts, least_words, least_exponent)
        best = [best_run(r) for r in runs]
        return {
            "n_words": [len(t) for t in texts], "runs": [[dict(zip(names, r)) for r in rs] for rs in runs],
            "best": [dict(zip(names, b)) if b else None for b in best],
            "collapsed": [collapsed(t, r).decode() for t, r in zip(texts, runs)],
        }

    return map_rows(docs, MADE, work, {"text": "bytes"}, keep)
