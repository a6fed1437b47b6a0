"""Token files: the public tokenizer's ids, exact round trips, single frames, damage."""

from __future__ import annotations

import glob
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from llm import token_files
from llm.token_files import FileBuilder, TokenFile, read, stored_tokens, write
from llm.word_encoder import WordEncoder
from tests.llm.conftest import edge_rows

MODEL = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


def _expected(library, rows):
    """(doc_id, ids) in order; only doc_ids that stand alone have a known order."""
    return {d: library.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}


def test_words_equal_the_whole_tokenizer(library):
    rng = random.Random(1)
    parts = [" "] * 6 + list("\n\t\r\x0b\x1c\x85\xa0 　 abAB12'.,!é水ñß")
    parts += ["'s", "'t", "<|endoftext|>", " the", "​", "᠎", "👍🏽", "\x00", "%%%", "word,"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 16))) for _ in range(8_000)]
    texts += ["", " ", "   ", "a  b", "a   b", "x\n  y", "end  ", "'ll don't, I'VE", "x" * 5_000]
    ids, ends = WordEncoder(open(MODEL).read()).encode(pa.array(texts))
    start = 0
    for text, end, want in zip(texts, ends, library.encode_batch(texts, add_special_tokens=False)):
        assert ids[start:end].tolist() == want.ids, repr(text)
        start = end


def test_other_tokenizers_encode_whole_texts():
    path = "/opt/tokenizers/word_bpe_49k.json"
    words = WordEncoder(open(path).read())
    texts = ["Some  words here", "", "one\ntwo"]
    ids, ends = words.encode(pa.array(texts))
    assert not words.by_words
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert np.split(ids, ends[:-1])[0].tolist() == want[0] and len(ids) == sum(map(len, want))


def test_words_are_forgotten_and_learned_again(library, monkeypatch, invented):
    monkeypatch.setattr("llm.word_encoder.WORDS_HELD", 50)
    words = WordEncoder(open(MODEL).read())
    for seed in range(6):
        text = invented(200, seed)
        ids, _ = words.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_stored_tokens(spark, library, invented, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 4_000)
    monkeypatch.setattr(token_files, "ROWS_PER_TASK", 100)
    rng = random.Random(3)
    rows = [(i, invented(rng.randint(1, 300), i), i) for i in rng.sample(range(10_000), 400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start int").repartition(7)
    folder = str(tmp_path / "files")
    found = {r.doc_id: r for r in stored_tokens(docs, MODEL, folder).collect()}
    want, start = _expected(library, [r[:2] for r in rows]), 0
    assert len(glob.glob(f"{folder}/part-*")) > 8
    for doc_id in sorted(want):
        ids = np.array(want[doc_id], "<u4")
        r = found[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    # A few documents are read again, with their ids.
    some = sorted(want)[5::90]
    got = {r.doc_id: r.token_ids for r in read(spark, folder, some + [-1], ids=True).collect()}
    assert got == {d: want[d] for d in some}


def test_edges(spark, library, edges, tmp_path):
    found = stored_tokens(edges, MODEL, str(tmp_path / "files")).collect()
    rows = [(r[0], r[1]) for r in edge_rows(lambda n, s: "")]
    assert len(found) == len(rows)
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in rows)
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.doc_id is None for r in by_start[:2]] == [True, True]
    ids = [r.doc_id for r in by_start[2:]]
    assert ids == sorted(ids) and by_start[0].start == 0
    for a, b in zip(by_start, by_start[1:]):
        assert b.start == a.start + a.n_tokens
    one = next(r for r in found if r.doc_id == 3)
    assert (one.n_tokens, one.ids_crc32) == (1, zlib.crc32(bytes(4)))


def test_no_documents(spark, make_docs, tmp_path):
    assert stored_tokens(make_docs([]), MODEL, str(tmp_path / "files")).count() == 0


def test_one_doc_id_everywhere(spark, invented, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "ROWS_PER_TASK", 20)
    texts = [invented(20, i) for i in range(200)]
    docs = spark.createDataFrame([(7, t) for t in texts], "doc_id bigint, text string")
    found = stored_tokens(docs, MODEL, str(tmp_path / "files")).collect()
    parts = {r.part for r in found}
    assert len(parts) > 3 and len({r.start for r in found}) == 200
    sizes = [len(i) for i in _expected(library, enumerate(texts)).values()]
    assert sum(r.n_tokens for r in found) == sum(sizes)


def _file(lists, monkeypatch=None, width=2):
    built = FileBuilder(width, 3, 4)
    for i, ids in enumerate(lists):
        built.add(i if i else None, np.array(ids, f"<u{width}"))
    return built.content()


def test_the_format_is_plain_zstandard():
    lists = [[5, 6, 0], [0], list(range(1_000)) + [0]]
    data = _file(lists)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    joined = np.frombuffer(plain.read(), "<u2").tolist()
    assert joined == [i for ids in lists for i in ids]
    # The last nine bytes: number of frames, flags, magic number.
    assert data[-9:] == (3).to_bytes(4, "little") + b"\x80" + bytes.fromhex("b1ea928f")


def test_only_wanted_frames_are_decompressed(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 64)
    lists = [list(range(i, i + 50)) for i in range(30)]
    file = TokenFile(memoryview(_file(lists)))
    assert (file.part, file.number, file.there.tolist()) == (3, 4, [False] + [True] * 29)
    assert file.ids(17).tolist() == lists[17]
    assert file.decompressed == 2 == file.frames[17]


def test_damage_is_found():
    data = bytearray(_file([[1, 2, 3, 0], [7] * 500]))
    good = TokenFile(memoryview(bytes(data)))
    end = int(good.ends[0])
    # A frame of its own right form, but with other content.
    other = bytearray(_file([[1, 2, 9, 0], [7] * 500]))
    data[:end] = other[:end]
    with pytest.raises(ValueError, match="damaged"):
        TokenFile(memoryview(bytes(data))).ids(0)
    assert TokenFile(memoryview(bytes(data))).ids(1).tolist() == [7] * 500
    with pytest.raises(ValueError):
        TokenFile(memoryview(bytes(data[:-1])))


def test_wide_ids_and_too_many_wanted(spark, tmp_path, monkeypatch):
    file = TokenFile(memoryview(_file([[70_000, 5]], width=4)))
    assert file.ids(0).tolist() == [70_000, 5]
    monkeypatch.setattr(token_files, "WANTED_SENT", 2)
    with pytest.raises(ValueError, match="at most"):
        read(spark, str(tmp_path), [1, 2, 3])


def test_long_documents_and_a_wide_end(spark, make_docs, invented, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 1_000)
    text = invented(20_000, 5)
    write(make_docs([(1, text)]), MODEL, str(tmp_path / "f"), end_id=70_000)
    row = read(spark, str(tmp_path / "f"), ids=True).first()
    assert row.token_ids == library.encode(text, add_special_tokens=False).ids + [70_000]
