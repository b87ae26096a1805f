"""Blocks of token ids: exact round trips, and the registered query against the library itself."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickertide.llm import queries as Q
from tickertide.llm import token_files

SMALL = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(BPE)
ENCODER = token_files.Encoder(BPE, 2)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=600), st.sampled_from([8, 12, 128, 256]), st.sampled_from([0, 50, 90, 100]))
def test_round_trip_of_any_ids(values, block, percentile):
    ids = np.array(values, dtype=np.uint32)
    data, starts = token_files.pack(ids, block, percentile)
    assert token_files.unpack(data, starts, len(ids), block).tolist() == values
    small = ids % 70_000
    data_, starts_ = token_files.pack(small, block, percentile)
    assert (token_files.unpack(data_, starts_, len(small), block) == small).all()
    # each block is read by itself
    single = [token_files.unpack_block(data, int(s), block).tolist() for s in starts]
    assert sum(single, [])[: len(values)] == values


def test_outliers_are_exceptions():
    ids = np.arange(256, dtype=np.uint32) % 16 + 1000
    ids[[3, 200]] = [50_000, 4_000_000_000]
    data, _ = token_files.pack(ids)
    # head, 256 times 4 bits, two exceptions of 6 bytes
    assert len(data) == 7 + 128 + 12
    assert len(token_files.pack(np.full(256, 7, np.uint32))[0]) == 7


def test_file_of_documents():
    docs = [np.arange(n, dtype=np.uint32) * 7 for n in (0, 1, 300, 5)]
    content = token_files.file_of([3, None, -4, 5], np.array([0, 1, 300, 5]), np.concatenate(docs), 6, 77) + b"\n"
    head, table, starts, data = token_files.parts_of(content)
    assert head == {"block": 256, "n_ids": 306, "partition": 6, "before": 77}
    assert table["id"].tolist() == [3, 0, -4, 5] and table["null"].tolist() == [0, 1, 0, 0] and table["first"].tolist() == [0, 0, 1, 301]
    assert (token_files.unpack(data, starts, 306) == np.concatenate(docs)).all()
    for broken in (content[:100], b"x" * 200):
        try:
            token_files.parts_of(broken)
        except ValueError:
            continue
        raise AssertionError("a broken file was read")


ODD = st.sampled_from(
    list(" \n\t\r\x0b\0\x1c\x1f\x85\xa0\u2003\u3000\u200b'!.,aAéß×÷漢5²½\u0301\U0001f600<|")
    + ["don't", " we'll", "!'s", "  ", "\n\n", "\u3000\n", "abc", " ab", "12", "<|endoftext|>"])


def whole(text):
    return MODEL.encode(text, add_special_tokens=False).ids + [2]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(ODD, max_size=30).map("".join), min_size=1, max_size=5))
def test_units_encode_as_whole_texts(texts):
    ids, sizes = ENCODER.encode([t.encode() for t in texts])
    assert sizes.tolist() == [len(whole(t)) for t in texts]
    assert ids.tolist() == sum(map(whole, texts), [])


def test_long_texts_and_forgotten_units(monkeypatch):
    text = "words  and\tblanks \n\n 12 don't é 漢字   x\xa0y a b c " * 40 + "y" * 500 + " end  "
    texts = [text, "", "z" * 300, " ".join(f"word{k * k % 97}é" for k in range(400)), text[::-1]]
    for piece, units in ((10, 20), (200, 50), (1 << 21, 1 << 18)):
        monkeypatch.setattr(token_files, "UNITS", units)
        monkeypatch.setattr(token_files, "PIECE", piece)
        encoder = token_files.Encoder(BPE, 2)
        ids, sizes = encoder.encode([t.encode() for t in texts])
        assert ids.tolist() == sum(map(whole, texts), []) and sizes.tolist() == [len(whole(t)) for t in texts]
    assert len(token_files.pieces(text.encode(), 50)) > 20 and b"".join(token_files.pieces(text.encode(), 50)) == text.encode()
    assert token_files.pieces(b"z" * 100, 10) == [b"z" * 100]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(token_files, "_hashes", lambda a, b, sizes: np.zeros(len(a), dtype=np.uint64))
    ids, _ = token_files.Encoder(BPE, 2).encode([b"one two three two", b"two"])
    assert ids.tolist() == whole("one two three two") + whole("two")


class Counted:
    """A tokenizer that counts the texts it encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **more)


def test_new_words_go_to_the_library_many_at_a_time():
    words = [f"{a}{b}{c}" for a in ("th", "É", "x", "ß") for b in ("ion", "öñ", "qu", "ÿÀe") for c in "abcdefghijklmnopqrstuvwxyzéØ"]
    texts = [" ".join([w, w.upper(), str(k * 7919)]) + f"\n{w}s\n{k}0" for k, w in enumerate(words)] + ["", "\n", " ", "\0 \x7f\xad"]
    encoder = token_files.Encoder(BPE, 2)
    counted = [Counted(getattr(encoder, name)) for name in ("model", "words") if hasattr(encoder, name)]
    for name, one in zip(("model", "words"), counted):
        setattr(encoder, name, one)
    for _ in range(2):
        ids, sizes = encoder.encode([t.encode() for t in texts])
        assert ids.tolist() == sum(map(whole, texts), []) and sizes.tolist() == [len(whole(t)) for t in texts]
    assert sum(one.texts for one in counted) < len(words) / 2


def expected(rows):
    model, start, out = Tokenizer.from_file(BPE), 0, []
    for doc_id, text in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_many_files_and_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 50)
    rows = [(k * 37 % 501, f"text {k} " * (k % 9), k) for k in range(501)]
    rows += [(None, "no id", 0), (-5, None, 0), (-6, "", 0), (-7, "long " * 3000, 0), (700, "twice", 0), (700, "twice", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(7)
    folder = f"file://{tmp_path}/files"
    token_files.write_tokens(docs, BPE, folder)
    found = token_files.read_tokens(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    ordered = sorted([r[:2] for r in rows], key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(found.collect(), key=lambda r: r["start"])
    assert [tuple(r)[:4] for r in got] == expected(ordered)
    model = Tokenizer.from_file(BPE)
    assert all(model.decode(r["ids"][:-1]) == (t or "") for r, (_, t) in zip(got, ordered))
    assert len(list((tmp_path / "files").glob("part-*"))) > 20
    empty = f"file://{tmp_path}/empty"
    token_files.write_tokens(docs.limit(0), BPE, empty)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_query_against_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy(F.col("doc_id")).select("doc_id", "text").collect()
    found = Q.QUERIES["op13_token_files"](spark, SMALL).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == expected([tuple(r) for r in docs])
