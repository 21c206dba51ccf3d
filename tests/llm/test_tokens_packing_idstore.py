import random
import uuid

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SF001
from odd_rows import no_docs, odd_docs  # noqa: F401
from weblake.llm import idstore, packing, tokens
from weblake.llm.queries import BYTE_BPE, QUERIES
from weblake.llm.tokens import TokenIds
from weblake.session import checkpoint_dir


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTE_BPE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(spark, library):
    own = TokenIds(BYTE_BPE)
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect()]
    texts += ["", " ", "a  b", " a", "a ", "a \n b", "日本 語、x", "a\x1c b", "don't 12ab ½ ²x", "\n\n a", "a b c", "x <|endoftext|> y", "x<|endoftext|>", "<|endoftext|", "😀 ok", "'tis it's 'a", "--a 12.5% (b)"]
    rng = random.Random(3)
    texts += ["".join(rng.choice("ab1 .\n\té日'") for _ in range(30)) for _ in range(500)]
    assert [np.frombuffer(own.ids(t), "<u4").tolist() for t in texts] == [library(t) for t in texts]


def test_words_come_back_from_the_older_generation(library, monkeypatch):
    monkeypatch.setattr(tokens, "GENERATION", 5_000)
    own, rng = TokenIds(BYTE_BPE), random.Random(1)
    texts = ["x " + " ".join(f"w{rng.randint(0, 60)}.{rng.randint(0, 9)}" for _ in range(50)) for _ in range(30)]
    for _ in range(2):
        assert [np.frombuffer(own.ids(t), "<u4").tolist() for t in texts] == [library(t) for t in texts]
        assert own.words.older and sum(len(k) + len(v) + tokens.ENTRY for k, v in own.words.items()) <= 5_000
        own.rest(keep=False)
        assert not own.words and not own.words.older and not own.words.inner


@pytest.mark.parametrize("capacity,tail", [(1024, 32), (64, 8), (100, 7), (1, 1)])
def test_cuts(capacity, tail):
    for n in range(1, 3 * capacity + 5):
        pieces = packing.cuts(n, capacity, tail)
        assert sum(pieces) == n and all(0 < p <= capacity for p in pieces)


def _check_packed(rows, expected, capacity=1024):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
        assert len(r.tokens) == 4 * r.length > 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    pads = [0 if n & (n - 1) == 0 else capacity - n for n in (sum(x[1] for x in p) for p in by_seq.values())]
    for doc, ids in expected.items():
        data = b"".join(bytes(r.tokens) for r in sorted(by_doc[doc], key=lambda r: r.start))
        assert np.frombuffer(data, "<u4").tolist() == ids
    return sum(pads) / sum(r.length for r in rows)


def test_packing_is_exact_and_tight(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = packing.pack(docs, BYTE_BPE).collect()
    assert _check_packed(rows, {r.doc_id: library(r.text) + [0] for r in docs.collect()}) < 0.01


def test_packing_odd_rows(odd_docs, no_docs, library):
    rows = packing.pack(odd_docs.where("doc_id is null or doc_id not in (4)"), BYTE_BPE).collect()
    _check_packed([r for r in rows], {1: [0], 2: [0], 3: library("long " * 5000 + "tail") + [0]})
    twice = [r for r in packing.pack(odd_docs.where("doc_id = 4"), BYTE_BPE).collect() if r.start == 0]
    assert len(twice) == 2
    assert packing.pack(no_docs, BYTE_BPE).collect() == []


def test_packing_takes_a_fixed_number_per_bin():
    bins = packing.HarmonicBins(1024, 0)
    for i in range(33 * 4):
        bins.add((i, 0, 31, b"\0" * 4 * 31))
    assert [sum(r[4] == s for r in bins.closed) for s in range(4)] == [33] * 4 and not bins.open


def test_idstore_round_trip(spark, odd_docs, no_docs, library):
    folder = f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
    idstore.write_ids(odd_docs, folder, BYTE_BPE)
    rows = idstore.read_ids(spark, folder).collect()
    want = sorted(((r.doc_id, library(r.text) + [0]) for r in odd_docs.collect()), key=str)
    assert sorted(((r.doc_id, np.frombuffer(bytes(r.tokens), "<u4").tolist()) for r in rows), key=str) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [None, None, 0, 1, 2, 3, 4, 4, 5, 6]
    assert [len(b) for b in idstore.lookup(spark, folder, 4)] == [4 * (len(library("same text")) + 1)] * 2
    assert idstore.lookup(spark, folder, 99) == []
    idstore.write_ids(no_docs, folder + "-none", BYTE_BPE)
    assert idstore.read_ids(spark, folder + "-none").collect() == []


def test_idstore_checks_its_dictionary(spark, odd_docs):
    folder = f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
    idstore.write_ids(spark.read.parquet(f"{SF001}/documents.parquet"), folder, BYTE_BPE)
    name = spark.read.parquet(f"{folder}/manifest").where("docs > 0").first().name
    f, p = idstore._open(f"{folder}/dictionary.bin")
    assert len(idstore._get(f"{folder}/dictionary.bin")) > 1000
    with f.open_output_stream(p) as s:
        s.write(b"another")
    with pytest.raises(ValueError):
        idstore.Shard(folder, name)


def test_op1_and_op5_agree_with_brute_force(spark, library):
    import zlib
    docs = {r.doc_id: np.array(library(r.text) + [0], "<u4") for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in QUERIES["op1_harmonic_packing"](spark, SF001).collect():
        assert r.doc_tokens == len(docs[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(docs[r.doc_id][r.start:r.start + r.length].tobytes())
    start = 0
    for r in QUERIES["op5_id_shards"](spark, SF001).orderBy("doc_id").collect():
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(docs[r.doc_id]), zlib.crc32(docs[r.doc_id].tobytes()))
        start += r.n_tokens


def test_line_ends_and_first_words_take_the_library_ids(monkeypatch):
    """Words with newlines, ASCII and not; a first word of ASCII letters needs no call of the library."""
    path = BYTE_BPE
    library, own = Tokenizer.from_file(path), TokenIds(path)
    texts = ["Hello a the.\nWhrehe, x's\n's élan.\nÉtat b", "É 1\n2\nthree !!!\n??? a\n\nb c", "x a\n\n\nb", "don't we'll\nI'm 12ab\n34é×÷\nz", "a it\nÀ×b q", "word NDHAED!! 5,000.00\n$$$ x",
             "abc \x7fq a\x00b\nc d", "x a\r\nb c", "x a\tb\nc", "x \na b", "x a\n b"]
    for t in texts * 2:
        assert own.ids(t) == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    monkeypatch.setattr(tokens, "_whole", None)
    assert own.ids("Unmet words") == np.array(library.encode("Unmet words", add_special_tokens=False).ids, "<u4").tobytes()
