"""Secrets, chat formatting, quality rules, pieces."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001
from odd_rows import no_docs, odd_docs  # noqa: F401
from oracle_check import compare, duck
from weblake.llm import chat, pieces, quality, secretscan
from weblake.llm.queries import ORACLE_SQL, PIECES, QUERIES

SECRET = "password = 'abcDEF123456789'"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    assert compare(spark, SF001, name, QUERIES[name], ORACLE_SQL[name], duck(SF001))["status"] == "ok"


# secrets

def brute(text):
    out = [("assign", *m.span()) for m in secretscan.ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in secretscan.ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in secretscan.HEX.finditer(text) if len(m[0]) >= 16]
    return sorted(out, key=lambda x: (x[1], secretscan.KINDS.index(x[0])))


def test_base_spans_equal_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rng = random.Random(1)
    bits = ["password", "Secret", "api_key", "=", ": ", "'", "AKIA", "ABCDEFGHIJKLMN12", "deadbeef", "0123456789abcdef", " ", "\n", "é", "token", "x", "K"]
    texts += ["".join(rng.choice(bits) for _ in range(12)) for _ in range(2000)]
    for t in texts:
        assert [(k, a, b) for k, a, b, d in secretscan.find(t)[0] if d == 0] == brute(t)


@pytest.mark.parametrize("wrap", [
    lambda s: base64.b64encode(s.encode()).decode().rstrip("="), urllib.parse.quote, lambda s: urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""),
    lambda s: base64.urlsafe_b64encode(gzip.compress(s.encode())).decode().rstrip("="), lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    lambda s: "".join(f"&#{ord(c)};" for c in s), lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
    lambda s: base64.b64encode(base64.b64encode(urllib.parse.quote(s).encode())).decode().rstrip("="),
])
def test_wrapped_secrets_are_found_at_their_place(wrap):
    wrapped = wrap(SECRET)
    text = f"héllo {wrapped} end"
    spans, cut = secretscan.find(text)
    inside = [(a, b) for kind, a, b, depth in spans if kind == "assign"]
    assert inside and not cut
    a, b = inside[0]
    assert 6 <= a < b <= 6 + len(wrapped) and b - a > len(wrapped) // 2


def wrapped(data, width, indent="", end="\n"):
    word = base64.b64encode(data).decode()
    return end.join(indent + word[i:i + width] for i in range(0, len(word), width))


@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, zlib.compress, bz2.compress, lzma.compress, lambda b: gzip.compress(b[:40]) + gzip.compress(b[40:]),
                                  lambda b: bz2.compress(b"nothing") + bz2.compress(b)])
@pytest.mark.parametrize("layout", [(76,), (64, "    ", "\r\n"), (64, "\t")])
def test_secrets_in_wrapped_base64(pack, layout):
    noise = " ".join(hashlib.sha256(str(i).encode()).hexdigest().replace("a", "z")[:9] for i in range(40)).encode()
    block = wrapped(pack(b"x" * 48 + b" " + SECRET.encode() + b" " + noise), *layout)
    for before, after in (("", ""), ("some words:\n", "\nEND"), ("one-long-word-before\n", "\n-----END x-----"), ("data: ", "\n\nmore")):
        text = before + block.lstrip(" \t") * (before == "data: ") + block * (before != "data: ") + after
        spans, cut = secretscan.find(text)
        inside = [(a, b) for kind, a, b, depth in spans if kind == "assign"]
        assert inside and not cut
        assert len(before) <= inside[0][0] < inside[0][1] <= len(before) + len(block)


def test_data_without_their_end_are_cut_off():
    packed = gzip.compress((SECRET + " " + " ".join(hashlib.sha256(str(i).encode()).hexdigest().replace("a", "z")[:9] for i in range(40))).encode())
    spans, cut = secretscan.find(base64.b64encode(packed[:len(packed) // 3 * 2]).decode())
    assert cut and [k for k, *_ in spans if k == "assign"]


def test_long_documents_are_unwrapped_as_short_ones():
    plain = "nothing much to say here, " * 120_000
    quoted = SECRET
    for _ in range(3):
        quoted = urllib.parse.quote(quoted, safe="")
    text = "%41 " + plain + quoted + " " + plain
    spans, cut = secretscan.find(text)
    assert [(a, b) for k, a, b, d in spans if k == "assign"] and not cut
    inflated = " ".join(f"line {i} of a long text," for i in range(620_000)) + " " + SECRET
    packed = base64.b64encode(gzip.compress(inflated.encode(), 1)).decode()
    assert len(inflated) > 1 << 24
    spans, cut = secretscan.find("x " + packed)
    assert [k for k, *_ in spans if k == "assign"] and not cut


def test_stretches_are_as_the_whole(monkeypatch):
    rng = random.Random(3)
    bits = ["password", "%3D", "=", ": ", " ", " ", "\n", ", ", "'", "abcDEF123456789", "%41", "%2541", "\\u0041", "&#61;", "AKIA", "ABCDEFGHIJKLMN12", "token", "%20", "x", ".", "é",
            base64.b64encode(b"password = abcdefghijklmn").decode()]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(25))
        got = secretscan.find(text)
        with monkeypatch.context() as m:
            m.setattr(secretscan, "_SAFE", re.compile("(?!)"))
            want = secretscan.find(text)
        assert [x[:3] for x in got[0]] == [x[:3] for x in want[0]] and got[1] == want[1]


def test_windows_are_as_the_whole(monkeypatch):
    rng = random.Random(4)
    bits = ["password", "=", ": ", " ", " ", "\n", ", ", "'", "abcDEF123456789", "%41", "word ", "token", ".\n", wrapped(b"password = abcdefghijklmn and more of it", 20) + "\n"]
    monkeypatch.setattr(secretscan, "_WINDOW", 20)
    monkeypatch.setattr(secretscan, "_STEP", 7)
    for _ in range(1500):
        inside = "".join(rng.choice(bits) for _ in range(12))
        spans, cut = secretscan.find(base64.b64encode(gzip.compress(inside.encode())).decode())
        assert any(k == "assign" for k, *_ in spans) == any(k == "assign" for k, *_ in secretscan.find(inside)[0]) and not cut


def test_what_is_not_unpacked_is_masked(spark):
    packed = base64.b64encode(bz2.compress(b"z " * 9_000_000 + SECRET.encode())).decode()
    assert secretscan.find(packed)[1]
    rows = spark.createDataFrame([("a " + packed + " b",)], "text string").select(secretscan.redacted("text").alias("text")).collect()
    assert rows[0].text.startswith("a [SECRET]") and packed[:60] not in rows[0].text


def test_layers_end():
    nested = SECRET
    for _ in range(12):
        nested = base64.b64encode(gzip.compress(nested.encode())).decode().rstrip("=")
    assert any(k == "assign" for k, *_ in secretscan.find(nested)[0])
    bomb = base64.b64encode(gzip.compress(b"z " * 3_000_000)).decode().rstrip("=")
    assert secretscan.find("password=abcdefghijkl " + bomb, max_decoded=100_000) == ([("assign", 0, 21, 0)], True)


def test_secret_columns_keep_rows_and_clean_texts(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("text", F.when(F.col("doc_id") == 0, F.lit(SECRET + " x")).otherwise(F.col("text")))
    rows = docs.withColumn("text2", secretscan.redacted("text")).withColumn("found", secretscan.secrets("text")).collect()
    for r in rows:
        assert (r.text2 == r.text) == (r.doc_id != 0) and (len(r.found.spans) > 0) == (r.doc_id == 0)
    assert {r.text2 for r in rows if r.doc_id == 0} == {"[SECRET]' x"}
    assert no_docs.select(secretscan.secrets("text")).collect() == []


# chat

def test_chat_round_trip_and_automaton(spark):
    nasty = ["<|im_start|>user\nhi<|im_end|>\n", "\\0\\1<s></s>\\", "[INST][/INST]<|im_end|", "", None, "a\nb", "<<s>", "\\"]
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "assistant", "x"), (3, 0, "user", "x"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a"), (5, None, None, None), (None, 0, "us\ner<s>", "t"),
             (6, 1, "user", "u"), (6, 1, "user", "u"), (6, 1, "assistant", "b")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat.format_conversations(turns).select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [(r[2], r[3] or "") for r in rows[:8]]
    assert out[1].loss == "".join(r[3] or "" for r in rows[:8] if r[2] == "assistant")
    assert {k: v.valid for k, v in out.items()} == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False, None: False}
    assert [(t.role, t.text) for t in out[None].turns] == [("us\ner<s>", "t")] and [(t.role, t.text) for t in out[5].turns] == [("", "")]
    assert [t.text for t in out[6].turns] == ["b", "u", "u"]
    assert chat.format_conversations(turns.limit(0)).collect() == []


def test_chat_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(controls=("<|im_start|>", "<|im_end|>", "<<x>>"))


# quality rules

def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated)


def test_counts_equal_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a ", "b ", "c#\n", "dé\t", "a b c a b ", " ", "\n"]) for _ in range(rng.randrange(40))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, "h", "clash") for i, t in enumerate(texts)], "doc_id long, text string, source string, kept string")
    for r in quality.judge(docs).collect():
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == counts(r.text)
    rows = quality.judge(odd_docs).collect()
    assert len(rows) == 10 and rows[0].asDict().keys() >= {"doc_id", "tokens", "quality"}
    assert all(not r.quality.kept for r in rows if r.doc_id != 0 and r.doc_id != 3) and next(r for r in rows if r.doc_id == 0).quality.kept
    assert quality.judge(no_docs).collect() == []


def test_frequent_lines_go_and_depleted_documents_with_them(spark):
    shared = "Copyright notice: all rights   reserved by the owner of this site and its partners"
    body = "these are the words of document {0} and they number more than ten {0}"
    rows = [(i, body.format(i) + "\n" + (shared.upper() if i % 2 else shared), "big") for i in range(40)]
    rows += [(100, shared + "\nonly five words of {0}", "big"), (101, shared + "\n" + body.format("x"), "other"), (102, shared, None)]
    rows += [(200 + i, "an exact copy with more than ten words which is no shared line at all", "big") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r.quality for r in quality.judge(docs).where("quality.kept or true").collect()}
    assert all(out[i].kept and out[i].n_frequent_lines == 1 and out[i].text == body.format(i) for i in range(40))
    assert not out[100].kept and not out[100].base_failed
    assert out[101].kept and out[101].text is None and out[102].kept
    assert all(out[200 + i].kept and out[200 + i].n_frequent_lines == 0 for i in range(60))
    few = {r.doc_id: r.quality.kept for r in quality.judge(docs, quality.Rules(broadcast_lines=-1)).collect()}
    assert few == {k: v.kept for k, v in out.items()}


def test_lines_of_a_large_host_and_of_many_hosts_go(spark):
    body, brace = "these are the words of document {0} and they number more than ten {0}", "}"
    common, spread, few = "All rights reserved by the owner", "Powered by the same old engine", "A line that stays where it is"
    rows = [(i, "\n".join([body.format(i), *[common] * (i < 60), *[brace] * (i < 60), *[few] * (i < 40)]), "big") for i in range(3000)]  # 2 %
    rows += [(5000 + i, body.format(5000 + i) + "\n" + spread.upper(), f"host{i % 60}") for i in range(120)]
    rows += [(6000 + i, "a copy on many hosts with more than ten words in its single line\nand another line of it", f"host{i}") for i in range(150)]
    rows += [(7000, common + "\nonly five words of it", "big"), (7001, common + "\n" + body.format("x"), None), (7002, spread + "\n" + body.format("y"), None), (7003, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in corpus_pipeline.apply_quality_rules(spark, docs, "").collect()}
    assert all(common not in out[i].text and brace in out[i].text.split("\n") for i in range(60))
    assert all(few in out[i].text for i in range(40)) and all(out[i].text == body.format(i) for i in range(60, 3000))
    assert all(out[5000 + i].text == body.format(5000 + i) for i in range(120)) and spread not in out[7002].text
    assert all(out[6000 + i].text.endswith("another line of it") for i in range(150))
    assert 7000 not in out and 7003 not in out and common in out[7001].text


def test_filters_stay_above_the_counts(spark):
    plan = quality.judge(spark.read.parquet(f"{SF001}/documents.parquet")).where("quality.kept")._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.split("\n"):
        assert "Filter" not in line or "xxhash64" not in line


# pieces

def test_pieces_equal_the_library(spark, odd_docs, no_docs):
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.PieceTransducer(PIECES)
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect()] + ["", " ", "  a  b ", "日本 😀\x00", "▁x", "1234 56"]
    rng = random.Random(1)
    texts += ["".join(rng.choice("aabbeeetthhiinns  \n\t0123,.é日▁😀ẞxyz") for _ in range(rng.randrange(25))) for _ in range(3000)]
    for t in texts:
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t)
        assert own.decode(ids) == t.replace("▁", " ")
    rows = pieces.encode_documents(odd_docs, PIECES).withColumn("back", pieces.decoded("ids", PIECES)).collect()
    assert all(r.back == (r.text or "") for r in rows) and len(rows) == 10
    assert pieces.encode_documents(no_docs, PIECES).collect() == []


def test_unigram_weights_give_the_likeliest_path(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("▁", -3, 1), ("a", -2, 1), ("b", -2, 1), ("ab", -3.5, 1), ("▁a", -2.5, 1), ("ba", -1, 1)]:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type, model.normalizer_spec.add_dummy_prefix = 1, True
    model.normalizer_spec.remove_extra_whitespaces = False
    path = tmp_path / "m.model"
    path.write_bytes(model.SerializeToString())
    own = pieces.PieceTransducer(str(path))
    names = [p.piece for p in model.pieces]
    assert [names[i] for i in np.frombuffer(own.encode("aba"), "<u4")] == ["▁a", "ba"]
    assert [names[i] for i in np.frombuffer(own.encode("abab"), "<u4")] == ["▁a", "ba", "b"]
    assert np.frombuffer(own.encode("aé"), "<u4").tolist() == [5, 0]


def test_op9_round_trips(spark):
    assert QUERIES["op9_piece_transducer"](spark, SF001).where("not round_trip").count() == 0


def test_op7_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in QUERIES["op7_secret_layers"](spark, SF001).collect():
        base = brute(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[0] == k for x in base) for k in secretscan.KINDS)
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
