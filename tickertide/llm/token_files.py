"""Token ids of a corpus in binary files of patched frame-of-reference blocks.

write_tokens() sorts the documents by doc_id over the cluster (range partitions), encodes them, ends each with
`end_id` and writes files; read_tokens() reads them back, each file by itself, in any number of tasks. The files
together are one sequence of ids: partition by partition, file by file.

A file, little-endian:

    8 bytes      magic TTPFOR01
    6 x uint64   block size, ids, documents, partition, ids of this partition before this file, bytes of the blocks
    per document int64 doc_id, uint8 (1: the id is null), uint64 its first id's place in the file
    per block    uint64 where the block starts in the bytes of the blocks, so that any block is read by itself
    the blocks:  uint32 minimum, uint8 width, uint16 exceptions; the ids minus the minimum, `width` bits each, highest
                 bits first; per exception uint16 place; per exception uint32 what is above the lowest `width` bits
    1 byte       line feed (the writer's end of record; not counted above)

The width of a block is that of the value at `percentile` of its ids minus the minimum; larger values are exceptions, of which the
lowest bits stay in place. The last block of a file is padded with its minimum.

The tokenizer must be a byte-level BPE with the usual pattern for words (no normalizer, no added blank). It merges bytes
only within a word, its blank before it, a run of digits, of symbols or of white space. Texts are cut at places where two such runs
surely meet (see unit_starts); a task has the library encode each distinct unit once, many new words at a time, and looks repetitions up. The
tests hold the ids against whole texts encoded by the library. Texts with strings of special tokens are encoded whole.

A file holds whole documents, up to FILE_IDS ids or those of one piece of work (PIECE bytes of text, or one longer
document), which bounds the memory. Files are committed by Spark, so tasks of lost executors are repeated.

Null text: empty, so that only the end id is left. Null ids come first and are kept as null. Rows with equal ids come in the
order of a hash of their texts, repeated rows side by side. Empty tables give files without documents or none. Other columns are ignored.
doc_id must be a whole number; the tokenizer is named by its path, which every executor must have.
"""

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickertide.llm.common import mix, small_batches, text_key

MAGIC = b"TTPFOR01"
HEAD = struct.Struct("<8s6Q")
BLOCK, PERCENTILE = 256, 90
FILE_IDS = 1 << 21
#: Bytes of text that are encoded together, and units that a worker remembers.
PIECE, UNITS = 1 << 22, 1 << 19
#: Words that the library encodes as one text.
TOGETHER = 1 << 7
#: Blocks whose bits are spread out at a time.
SLICE = 512


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value below 2**32 takes."""
    return np.where(values > 0, np.frexp(values.astype(np.float64))[1], 0).astype(np.int64)


def _joined(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of values of up to 32 bits as rows of bytes, `width` bits a value."""
    n, block = rows.shape
    rows = rows & np.uint32((1 << width) - 1)
    if width > 16 or block % 8:
        bits = np.unpackbits(rows.astype(">u4").view(np.uint8).reshape(n, block, 4), axis=2)
        return np.packbits(bits[:, :, 32 - width :].reshape(n, -1), axis=1)
    # four values fill half of an even number of bytes, eight a whole number
    v, w = rows.astype(np.uint64).reshape(n, block // 4, 4), np.uint64(width)
    fours = (((v[:, :, 0] << w | v[:, :, 1]) << w | v[:, :, 2]) << w) | v[:, :, 3]
    tail = lambda x, k: x.astype(">u8").view(np.uint8).reshape(*x.shape, 8)[:, :, 8 - k :]
    if width % 2 == 0:
        return tail(fours, width // 2).reshape(n, -1)
    high, low, rest, k = fours[:, 0::2], fours[:, 1::2], np.uint64(4 * width - 4), width // 2
    middle = ((high & np.uint64(15)) << np.uint64(4) | low >> rest).astype(np.uint8)
    low = low & ((np.uint64(1) << rest) - np.uint64(1))
    return np.concatenate([tail(high >> np.uint64(4), k), middle[:, :, None], tail(low, k)], axis=2).reshape(n, -1)


def _spread(packed: np.ndarray, width: int, block: int) -> np.ndarray:
    """The values of rows of bytes."""
    n = len(packed)
    if width > 16 or block % 8:
        bits = np.zeros((n, block, 32), dtype=np.uint8)
        bits[:, :, 32 - width :] = np.unpackbits(packed, axis=1)[:, : block * width].reshape(n, block, width)
        return np.packbits(bits, axis=2).reshape(n, -1).view(">u4").astype(np.uint32)

    def number(part):
        full = np.zeros((*part.shape[:2], 8), dtype=np.uint8)
        full[:, :, 8 - part.shape[2] :] = part
        return full.view(">u8")[:, :, 0].astype(np.uint64)

    if width % 2 == 0:
        fours = number(packed.reshape(n, block // 4, width // 2))
    else:
        parts, k, rest = packed.reshape(n, block // 8, width), width // 2, np.uint64(4 * width - 4)
        middle = parts[:, :, k].astype(np.uint64)
        fours = np.empty((n, block // 4), dtype=np.uint64)
        fours[:, 0::2] = number(parts[:, :, :k]) << np.uint64(4) | middle >> np.uint64(4)
        fours[:, 1::2] = (middle & np.uint64(15)) << rest | number(parts[:, :, k + 1 :])
    mask, out = np.uint64((1 << width) - 1), np.empty((n, block // 4, 4), dtype=np.uint32)
    for j in range(4):
        out[:, :, j] = fours >> np.uint64(width * (3 - j)) & mask
    return out.reshape(n, block)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """The bytes of the blocks of uint32 ids, and where each block starts."""
    n = -(-len(ids) // block)
    if not n:
        return b"", np.zeros(0, dtype=np.uint64)
    rows = np.empty(n * block, dtype=np.uint32)
    rows[: len(ids)] = ids
    rows[len(ids) :] = ids[(n - 1) * block :].min()
    rows = rows.reshape(n, block)
    low = rows.min(axis=1)
    rows = rows - low[:, None]
    at = min(block - 1, block * percentile // 100)
    widths = _bits(np.partition(rows, at, axis=1)[:, at])
    packed: list[bytes] = [b""] * n
    for width in np.unique(widths[widths > 0]).tolist():
        which = np.flatnonzero(widths == width)
        for k in range(0, len(which), SLICE):
            some = which[k : k + SLICE]
            lines = _joined(rows[some], width)
            size, data = lines.shape[1], lines.tobytes()
            for j, i in enumerate(some.tolist()):
                packed[i] = data[j * size : (j + 1) * size]
    # a shift by all 32 bits leaves nothing
    above = np.where(widths[:, None] < 32, rows >> np.minimum(widths, 31).astype(np.uint32)[:, None], np.uint32(0))
    at_row, place = np.nonzero(above)
    cuts = np.searchsorted(at_row, np.arange(n + 1))
    place, high = place.astype("<u2"), above[above > 0].astype("<u4")
    out, starts, size = [], np.zeros(n, dtype=np.uint64), 0
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        data = struct.pack("<IBH", int(low[i]), int(widths[i]), b - a) + packed[i] + place[a:b].tobytes() + high[a:b].tobytes()
        out.append(data)
        starts[i] = size
        size += len(data)
    return b"".join(out), starts


def unpack_block(data: bytes, start: int, block: int = BLOCK) -> np.ndarray:
    """The ids of the block that starts there."""
    low, width, n = struct.unpack_from("<IBH", data, start)
    at = start + 7
    size = (block * width + 7) // 8
    values = _spread(np.frombuffer(data, np.uint8, size, at)[None, :], width, block)[0] if width else np.zeros(block, dtype=np.uint32)
    if n:
        place = np.frombuffer(data, "<u2", n, at + size)
        values[place] |= np.frombuffer(data, "<u4", n, at + size + 2 * n) << np.uint32(width)
    return values + np.uint32(low)


def unpack(data: bytes, starts: np.ndarray, n_ids: int, block: int = BLOCK) -> np.ndarray:
    """All ids of the blocks; blocks of one width are taken together."""
    n = len(starts)
    raw = np.frombuffer(data, np.uint8)
    starts = starts.astype(np.int64)
    # low, width and exceptions of each block
    heads = raw[starts[:, None] + np.arange(7)] if n else np.zeros((0, 7), np.uint8)
    low = heads[:, :4].copy().view("<u4")[:, 0]
    widths, exceptions = heads[:, 4].astype(np.int64), heads[:, 5:7].copy().view("<u2")[:, 0].astype(np.int64)
    rows = np.zeros((n, block), dtype=np.uint32)
    for width in np.unique(widths[widths > 0]).tolist():
        which = np.flatnonzero(widths == width)
        size = (block * width + 7) // 8
        for k in range(0, len(which), SLICE):
            some = which[k : k + SLICE]
            rows[some] = _spread(raw[(starts[some] + 7)[:, None] + np.arange(size)], width, block)
    owner = np.repeat(np.arange(n), exceptions)
    if len(owner):
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        at = (starts + 7 + (block * widths + 7) // 8)[owner]
        place = raw[(at + 2 * nth)[:, None] + np.arange(2)].view("<u2")[:, 0]
        high = raw[(at + 2 * exceptions[owner] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0]
        rows[owner, place] |= high << widths[owner].astype(np.uint32)
    rows += low[:, None]
    return rows.reshape(-1)[:n_ids]


def file_of(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, partition: int, before: int, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """One file of whole documents: their ids in a row, and how many each has."""
    firsts = np.cumsum(sizes) - sizes
    data, starts = pack(ids, block, percentile)
    docs = np.zeros(len(doc_ids), dtype=[("id", "<i8"), ("null", "u1"), ("first", "<u8")])
    docs["id"] = [d or 0 for d in doc_ids]
    docs["null"] = [d is None for d in doc_ids]
    docs["first"] = firsts
    head = HEAD.pack(MAGIC, block, len(ids), len(doc_ids), partition, before, len(data))
    return b"".join([head, docs.tobytes(), starts.astype("<u8").tobytes(), data])


def parts_of(content: bytes) -> tuple[dict, np.ndarray, np.ndarray, bytes]:
    """Head, documents, block starts and blocks of a file; the blocks are not read."""
    magic, block, n_ids, n_docs, partition, before, size = HEAD.unpack_from(content, 0)
    if magic != MAGIC:
        raise ValueError("not a file of token blocks")
    n_blocks = -(-n_ids // block)
    docs = np.frombuffer(content, [("id", "<i8"), ("null", "u1"), ("first", "<u8")], n_docs, HEAD.size)
    at = HEAD.size + docs.nbytes
    starts = np.frombuffer(content, "<u8", n_blocks, at)
    at += starts.nbytes
    if len(content) < at + size:
        raise ValueError("file of token blocks is cut off")
    return {"block": block, "n_ids": n_ids, "partition": partition, "before": before}, docs, starts, content[at : at + size]


# kinds of bytes
BLANK, GAP, LETTER, DIGIT, SYMBOL, APOSTROPHE, OTHER = range(7)
_KIND = np.full(256, SYMBOL, dtype=np.uint8)
_KIND[128:] = OTHER
_KIND[9:14] = GAP
_KIND[32], _KIND[39] = BLANK, APOSTROPHE
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
_KINDS = _KIND.tobytes()
_BETWEEN = re.compile(rb"[A-Za-z] [A-Za-z]")
# words and numbers of known characters, in UTF-8
_PLAIN = re.compile(rb"( ?)(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]+)")
# the characters that stand for bytes in the vocabulary; that of a line feed for byte 0, as a line feed parts words here
_SIGNS = np.arange(256, dtype="<u4")
_SIGNS[[0, 32, 173]] = 0x10A, 0x120, 0x143
_SIGNS[127:161] += 162

# between two kinds: no cut, a cut, or it depends on their neighbours
CUT, BOTH_WHITE, AFTER_GAP = 1, 2, 3


def _cuts() -> bytes:
    """What is between two kinds, by 8 * first + second. Beside OTHER, and after an apostrophe, which letters may follow, a run may go on."""
    table = np.zeros(256, dtype=np.uint8)
    known = (LETTER, DIGIT, SYMBOL, APOSTROPHE)
    for a in known:
        for b in (BLANK, GAP, *known):
            same_run = a == b or {a, b} == {SYMBOL, APOSTROPHE} or (a, b) == (APOSTROPHE, LETTER)
            table[8 * a + b] = 0 if same_run else CUT
        table[8 * GAP + a] = AFTER_GAP
    for a in (BLANK, GAP):
        for b in (BLANK, GAP):
            table[8 * a + b] = BOTH_WHITE
    return table.tobytes()


_CUTS = _cuts()


def unit_starts(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Where units start in the bytes of texts (UTF-8), each with one more byte at its end.

    A blank belongs to the word after it; other white space parts words. Of several white spaces before a word, the
    last is by itself or with the word, the others are together. Beside characters of unknown kind nothing is cut.
    """
    raw = np.frombuffer(data, np.uint8)
    kind = np.frombuffer(data.translate(_KINDS), np.uint8).copy()
    # two-byte letters from U+00C0 to U+00FF
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    kind[ends] = OTHER
    between = np.frombuffer((kind[:-1] << 3 | kind[1:]).tobytes().translate(_CUTS), np.uint8)
    starts = np.zeros(len(raw) + 1, dtype=bool)
    starts[1:-1] = between == CUT
    white = np.flatnonzero(between == BOTH_WHITE)
    after = kind[white + 2]
    starts[white + 1] = (after > GAP) & (after < OTHER)
    # with white space of unknown kind before it, a gap is not by itself
    gap = np.flatnonzero(between == AFTER_GAP)
    starts[gap + 1] = (gap == 0) | (kind[gap - 1] != OTHER)
    starts[0] = starts[ends] = starts[ends + 1] = True
    return np.flatnonzero(starts[:-1])


def pieces(text: bytes, most: int) -> list[bytes]:
    """The text in pieces of about `most` bytes, cut before a blank between two letters."""
    out, start = [], 0
    while len(text) - start > most:
        cut = _BETWEEN.search(text, start + most)
        if not cut:
            break
        out.append(text[start : cut.start() + 1])
        start = cut.start() + 1
    return out + [text[start:]]


_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _eight(words: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Up to eight bytes at each place as one number."""
    word, shift = at >> 3, (at.astype(np.uint64) & np.uint64(7)) << np.uint64(3)
    # a shift by 64 in two steps
    high = words[word + 1] << (np.uint64(63) - shift) << np.uint64(1)
    return (words[word] >> shift | high) & _MASK[np.clip(sizes, 0, 8)]


def _hashes(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return mix(a ^ mix(b + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def distinct_units(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per unit the number of its kind; per kind a unit of it; per kind its bytes as two numbers (those of up to 16 bytes)."""
    words = np.frombuffer(data + bytes(24 - len(data) % 8), "<u8")
    a, b = _eight(words, starts, sizes), _eight(words, np.minimum(starts + 8, len(data)), sizes - 8)
    # longer units get a number each
    names: dict[bytes, int] = {}
    for k in np.flatnonzero(sizes > 16).tolist():
        a[k], b[k] = names.setdefault(data[starts[k] : starts[k] + sizes[k]], len(names)), 0
    codes, kinds = pd.factorize(_hashes(a, b, sizes))
    first = np.empty(len(kinds), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    model = first[codes]
    if not ((a[model] == a).all() and (b[model] == b).all() and (sizes[model] == sizes).all()):
        # two units have one hash
        names = {}
        codes = np.fromiter((names.setdefault(data[s : s + n], len(names)) for s, n in zip(starts.tolist(), sizes.tolist())), np.int64, len(starts))
        first = np.empty(len(names), dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, first, np.stack([a[first], b[first]])


def _rows(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs, one run after the other."""
    stops = np.cumsum(sizes)
    return np.arange(stops[-1] if len(stops) else 0) + np.repeat(firsts - (stops - sizes), sizes)


class Encoder:
    """Ids of texts, each with the end id; the library encodes each unit once.

    Up to UNITS units are remembered; beyond that, those stay that more pieces of text have had. Units of up to 16 bytes are found by
    a sorted table of their hashes and compared in full, others and those whose hash another unit has by a dictionary.
    """

    def __init__(self, tokenizer: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(tokenizer)
        # the same merges for words that are cut already
        self.words = Tokenizer(self.model.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.end_id = end_id
        self.specials = [t.content.encode() for t in self.model.get_added_tokens_decoder().values()]
        # ids that start a word with its blank, and that of a line feed
        vocabulary = self.model.get_vocab()
        self.blank = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.blank[[k for token, k in vocabulary.items() if token.startswith("\u0120")]] = True
        self.feed = vocabulary.get("\u010a", -1)
        self._clear()

    def _clear(self) -> None:
        # unit 0 is nothing, unit 1 the end of a text
        self.ids = np.array([self.end_id], dtype=np.uint32)
        self.firsts, self.sizes, self.uses = np.array([0, 0]), np.array([0, 1]), np.array([0, 0])
        self.lengths, self.parts = np.array([-1, -1]), np.zeros((2, 2), dtype=np.uint64)
        self.hashes, self.owners = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.numbers: dict[bytes, int] = {}

    def _forget(self) -> None:
        uses = self.uses
        least = 2
        while (uses >= least).sum() > UNITS // 2:
            least *= 2
        kept = uses >= least
        # the reserved ones stay
        kept[:2] = True
        number = np.cumsum(kept) - 1
        self.ids = self.ids[_rows(self.firsts[kept], self.sizes[kept])]
        self.sizes, self.lengths, self.parts, self.uses = self.sizes[kept], self.lengths[kept], self.parts[:, kept], uses[kept] // 2
        # both reserved ones start at 0
        self.firsts = np.cumsum(self.sizes) - self.sizes
        there = kept[self.owners]
        self.hashes, self.owners = self.hashes[there], number[self.owners[there]]
        self.numbers = {unit: int(number[k]) for unit, k in self.numbers.items() if kept[k]}

    def _add(self, units: list[bytes], lengths: np.ndarray, parts: np.ndarray, hashes: np.ndarray) -> None:
        """Remember new units, each given once."""
        ids, sizes = self._ids_of(units)
        at = len(self.firsts)
        self.firsts = np.append(self.firsts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.ids, self.sizes, self.uses = np.append(self.ids, ids), np.append(self.sizes, sizes), np.append(self.uses, np.zeros(len(units), dtype=np.int64))
        self.lengths, self.parts = np.append(self.lengths, lengths), np.concatenate([self.parts, parts], axis=1)
        short = np.flatnonzero(lengths <= 16)
        found, which = np.unique(hashes[short], return_index=True)
        places = np.searchsorted(self.hashes, found)
        fresh = np.append(self.hashes, np.uint64(0))[places] != found
        fresh |= places == len(self.hashes)
        which, places = short[which[fresh]], places[fresh]
        self.hashes, self.owners = np.insert(self.hashes, places, found[fresh]), np.insert(self.owners, places, at + which)
        others = np.ones(len(units), dtype=bool)
        others[which] = False
        self.numbers.update((units[k], at + k) for k in np.flatnonzero(others).tolist())

    def _ids_of(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of units, and how many each has. Words go to the library many in a text, each cut from the next."""
        plain = [m and m[1] for m in map(_PLAIN.fullmatch, units)]
        order, found, sizes = [k for k, blank in enumerate(plain) if blank is None], [], []
        singles = self.model.encode_batch_fast([units[k].decode() for k in order], add_special_tokens=False)
        each = [e.ids for e in singles]
        for blank, sign in ((b" ", b""), (b"", b"\0\n")):
            which = [k for k, b in enumerate(plain) if b == blank]
            for k in range(0, len(which), TOGETHER):
                some = which[k : k + TOGETHER]
                text = sign + (b"\n" + sign).join([units[i] for i in some])
                text = _SIGNS[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le")
                ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
                heads = np.flatnonzero(ids == self.feed if sign else self.blank[ids])
                sizes.append(np.diff(heads, append=len(ids)) - bool(sign))
                found.append(np.delete(ids, heads) if sign else ids)
                order += some
        ids = np.concatenate([np.fromiter(chain.from_iterable(each), np.uint32), *found])
        sizes = np.concatenate([np.fromiter(map(len, each), np.int64, len(each)), *sizes])
        back = np.argsort(order)
        return ids[_rows((np.cumsum(sizes) - sizes)[back], sizes[back])], sizes[back]

    def _known(self, data: bytes, starts: np.ndarray, lengths: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """The numbers of units in the bytes, each given once."""
        hashes = _hashes(parts[0], parts[1], lengths)

        def look_up(which):
            out, others = np.full(len(which), -1), lengths[which] > 16
            if len(self.hashes):
                places = np.minimum(np.searchsorted(self.hashes, hashes[which]), len(self.hashes) - 1)
                at = np.flatnonzero((self.hashes[places] == hashes[which]) & ~others)
                owner, asked = self.owners[places[at]], which[at]
                same = (self.lengths[owner] == lengths[asked]) & (self.parts[0][owner] == parts[0][asked]) & (self.parts[1][owner] == parts[1][asked])
                out[at[same]] = owner[same]
                others[at[~same]] = True
            for k in np.flatnonzero(others).tolist():
                i = which[k]
                out[k] = self.numbers.get(data[starts[i] : starts[i] + lengths[i]], -1)
            return out

        # in the order of the table, which a search goes through faster
        order = np.argsort(hashes)
        numbers = np.empty(len(starts), dtype=np.int64)
        numbers[order] = look_up(order)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            if len(self.firsts) + len(new) > UNITS and len(self.firsts) > 2:
                self._forget()
                numbers[order] = look_up(order)
                new = np.flatnonzero(numbers < 0)
            numbers[new] = len(self.firsts) + np.arange(len(new))
            self._add([data[a : a + n] for a, n in zip(starts[new].tolist(), lengths[new].tolist())], lengths[new], parts[:, new], hashes[new])
        self.uses[numbers] += 1
        return numbers

    def _together(self, texts: list[bytes], whole: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and how many each has; those that are whole end with the end id."""
        data = b"\0".join(texts) + b"\0"
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = unit_starts(data, ends)
        sizes = np.diff(np.append(starts, len(data)))
        codes, first, parts = distinct_units(data, starts, sizes)
        which = self._known(data, starts[first], sizes[first], parts)[codes]
        at_end = np.searchsorted(starts, ends)
        which[at_end] = np.array(whole, dtype=np.int64)
        sizes = self.sizes[which]
        stops = np.cumsum(sizes)
        found = self.ids[_rows(self.firsts[which], sizes)]
        return found, np.diff(stops[at_end], prepend=0)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, in a row, and how many each has."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        owner, waiting, whole, size = [], [], [], 0

        def work():
            nonlocal waiting, whole, size
            if waiting:
                found.append(self._together(waiting, whole))
            waiting, whole, size = [], [], 0

        for k, text in enumerate(texts):
            if any(s in text for s in self.specials):
                # their strings are ids of their own, whatever stands around them
                work()
                ids = self.model.encode(text.decode(), add_special_tokens=False).ids + [self.end_id]
                found.append((np.array(ids, dtype=np.uint32), np.array([len(ids)])))
                owner.append(k)
                continue
            parts = pieces(text, PIECE)
            for i, part in enumerate(parts):
                waiting.append(part)
                whole.append(i == len(parts) - 1)
                owner.append(k)
                size += len(part)
                if size >= PIECE:
                    work()
        work()
        if not found:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        sizes = np.bincount(owner, weights=np.concatenate([f[1] for f in found]), minlength=len(texts)).astype(np.int64)
        return np.concatenate([f[0] for f in found]), sizes


@lru_cache(maxsize=1)
def encoder(tokenizer: str, end_id: int) -> Encoder:
    """Kept by a worker process for its next tasks."""
    return Encoder(tokenizer, end_id)


def valid(text: bytes | None) -> bytes:
    """UTF-8; broken characters are replaced."""
    try:
        (text or b"").decode()
    except UnicodeDecodeError:
        return text.decode(errors="replace").encode()
    return text or b""


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, block: int = BLOCK, percentile: int = PERCENTILE) -> None:
    """Write the ids of all documents, by ascending doc_id, to new files in the folder."""
    small_batches(docs.sparkSession, 4 << 20)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("key"))
    placed = given.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key", "text").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, partition, before = encoder(tokenizer, end_id).encode, TaskContext.get().partitionId(), 0
        doc_ids, parts, sizes, size = [], [], [], 0

        def made():
            nonlocal before, doc_ids, parts, sizes, size
            content = file_of(doc_ids, np.concatenate(sizes), np.concatenate(parts), partition, before, block, percentile)
            before += size
            doc_ids, parts, sizes, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            ids, counts = encode([valid(t) for t in batch.column(1).cast(pa.binary()).to_pylist()])
            ends, k = np.cumsum(counts), 0
            while k < len(names):
                start = int(ends[k] - counts[k])
                stop = int(np.searchsorted(ends, start + FILE_IDS - size, side="right"))
                if stop <= k and size:
                    yield made()
                    continue
                stop = max(stop, k + 1)
                doc_ids += names[k:stop]
                parts.append(ids[start : ends[stop - 1]])
                sizes.append(counts[k:stop])
                size += len(parts[-1])
                k = stop
        if doc_ids:
            yield made()

    # the text writer puts a string's bytes as they are; a record is a file
    files = placed.mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("content"))
    files.write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, if asked, ids) per document; start counts the ids of all documents before it."""
    small_batches(spark, 4 << 20)
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("content")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parts_of(bytes(c.as_buffer()))[0] for c in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h["partition"] for h in found], pa.int64()), pa.array([h["before"] + h["n_ids"] for h in found], pa.int64())],
                names=["partition", "ids"])

    names = ["partition", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * with_ids

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                head, docs, starts, data = parts_of(bytes(content.as_buffer()))
                ids = unpack(data, starts, head["n_ids"], head["block"])
                firsts = docs["first"].astype(np.int64)
                ends = np.append(firsts[1:], head["n_ids"])
                raw = memoryview(ids.astype("<u4").tobytes())
                columns = [
                    np.full(len(docs), head["partition"]), pa.array(docs["id"].astype(np.int64), mask=docs["null"] > 0), head["before"] + firsts, ends - firsts,
                    [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(firsts.tolist(), ends.tolist())]]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(firsts, head["n_ids"]), pa.int32()), pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names)

    # one row per partition of the writer: what all partitions before it hold
    sizes = files.mapInArrow(heads, "partition long, ids long").groupBy("partition").agg(F.max("ids").alias("ids"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("partition", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    made = "partition long, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return files.mapInArrow(documents, made).join(offsets, "partition").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), *names[3:])
