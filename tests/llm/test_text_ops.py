"""BPE, WARC, chat, vectorised words: exact round trips."""

import base64
import hashlib
import io
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm import bpe, chat, queries, shared, vec, warc

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
EXTRA = "extra string, "


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


# ---- BPE ----


@pytest.mark.parametrize("text", ["", "a", "x" * 70_000, "ab1" * 120_000, " " * 300_000 + "x", "word \n\n don't 12 \x1c" * 9000, "  \t" * 40_000, "é ñ!? <|endoftext|> " * 3000, "\n" * 40_000])
def test_long_texts_equal_tiktoken(plain, text, monkeypatch):
    monkeypatch.setattr(bpe, "GIANT", 50_000)
    c = bpe.Codec(RANKS, P.PATTERN)
    ids = c.encode(text)
    assert ids == plain.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\n\r\x1c\x85  ab'sétd1²!?", max_size=200))
def test_cuts_are_safe(text):
    c = bpe.codec(RANKS, P.PATTERN)
    long, giant = bpe.LONG, bpe.GIANT
    try:
        bpe.LONG, bpe.GIANT = 5, 12
        ids = c.encode(text)
    finally:
        bpe.LONG, bpe.GIANT = long, giant
    assert ids == c.encoding.encode_ordinary(text)


def test_bpe_rows(spark, plain):
    texts = [None, "", "hello world", "hello world", "é" * 40_000]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    rows = {r.doc_id: r for r in bpe.digest(docs, RANKS, P.PATTERN).collect()}
    for k, t in enumerate(texts):
        ids = np.array(plain.encode_ordinary(t or ""), "<u4").tobytes()
        assert tuple(rows[k])[1:] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()}
    assert back == {k: (t or "").encode() for k, t in enumerate(texts)}
    assert bpe.digest(docs.limit(0), RANKS, P.PATTERN).count() == 0


# ---- WARC ----


@pytest.mark.parametrize("zip64", [False, True])
def test_package(zip64):
    import zipfile

    out = io.BytesIO()
    w = warc.PackageWriter(out, zip64)
    records = [warc.build(k, "http://x/é\n%0A" if k % 2 else None, b"p" * k, "D", "response", None) for k in range(20)]
    for k, r in enumerate(records):
        w.add(warc.record_id(k), "response", r)
    n = w.finish()
    assert n == len(out.getvalue())
    p = warc.Package(io.BytesIO(out.getvalue()), n)
    import gzip

    assert [gzip.decompress(p.read(a, b)) for a, b in p.index()] == records
    z = zipfile.ZipFile(io.BytesIO(out.getvalue()))
    assert z.testzip() is None
    assert z.namelist() == [warc.DATA, warc.INDEX]
    with pytest.raises(ValueError, match="central directory"):
        warc.Package(io.BytesIO(b"no archive" * 5), 50)


def test_round_trip(spark, tmp_path):
    pages = [(1, "http://a/%20", "x"), (2, "u r\nl", "x"), (2, "u r\nl", "x"), (3, None, None), (4, "é", ""), (5, "z", "é" * 5000), (None, "n", "x")]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id bigint, url string, html string, payload string")
    manifest = shared.materialize(warc.write(warc.with_types(df), str(tmp_path / "w"), package_bytes=200, zip64=True), "t")
    rows = warc.read(manifest).collect()
    first = {"x": 1, "": 3, "é" * 5000: 5}
    expected = []
    for page, url, html in pages:
        b = (html or "").encode()
        own = first[html or ""] == page
        expected.append((page, url, "response" if own else "revisit", None if own else first[html or ""], len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), b if own else None))
    key = lambda r: repr(r)
    assert sorted([(*r[:6], None if r[6] is None else bytes(r[6])) for r in rows], key=key) == sorted(expected, key=key)
    # payloads below the least size are all responses
    assert {r.record_type for r in warc.with_types(df, least=2).collect()} == {"response"}
    assert warc.round_trip(df.limit(0)).count() == 0


# ---- chat ----


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="user\n\\<|>n", max_size=6), st.text(alphabet="ab<|\\>\nim_start", max_size=30)), max_size=5))
def test_template_is_reversible(turns):
    import re

    escape = lambda t: re.sub(r"<(\\*)\|", r"<\1\\|", t)
    role = lambda r: escape(r.replace("\\", "\\\\").replace("\n", "\\n"))
    text = "".join(f"{chat.START}{role(r)}\n{escape(t)}{chat.END}\n" for r, t in turns)
    assert list(chat.parse(text)) == turns


def test_segments_equal_python(spark):
    turns = [(7, 2, "assistant", "<|im_end|> <\\|x"), (7, 1, "us\\er\n", None), (7, 1, "a", "b"), (None, 1, None, "t"), (8, None, "assistant", "é" * 10), (8, 1, "assistant", "<|")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id bigint, turn bigint, role string, text string, segment int")
    segs = chat.segments(chat.turns_of_table(df))
    rows = {r.conv_id: r for r in chat.digest(segs).collect()}
    whole = {r.conv_id: r.formatted for r in chat.conversations(segs).collect()}
    for conv in (7, 8, None):
        own = sorted([(-1 if k is None else k, r or "", t or "") for c, k, r, t in turns if c == conv])
        said = "".join(t for _, r, t in own if r == "assistant")
        assert list(chat.parse(whole[conv])) == [(r, t) for _, r, t in own]
        assert tuple(rows[conv]) == (conv, len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(whole[conv]))


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string, role_ string")
    assert chat.digest(chat.segments(chat.turns_of_table(none))).count() == 0
    assert chat.conversations(chat.segments(chat.turns_of_table(none))).count() == 0
    assert chat.turns_of_records(spark.createDataFrame([], "conv_id bigint, record string")).count() == 0


def test_layouts(spark):
    records = {
        '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "system": "s", "extra": {"x": 1}}': ("messages", [("system", "s"), ("user", "q"), ("assistant", "a")]),
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": null}, {"from": "gpt", "value": "a"}]}': ("from_value", [("user", "q"), ("assistant", ""), ("assistant", "a")]),
        '{"instruction": "i", "input": "x", "output": "o"}': ("instruction", [("user", "i\n\nx"), ("assistant", "o")]),
        '{"instruction": "i", "input": null, "output": "o"}': ("instruction", [("user", "i"), ("assistant", "o")]),
        '{"prompt": "p", "response": "r"}': ("prompt_response", [("user", "p"), ("assistant", "r")]),
        '{"prompt": "p", "completion": "r"}': ("prompt_completion", [("user", "p"), ("assistant", "r")]),
        '{"question": "q", "answer": "a"}': ("question_answer", [("user", "q"), ("assistant", "a")]),
        '{"prompt": "p", "messages": []}': (None, [(None, None)]),
        "{broken": (None, [(None, None)]),
    }
    df = spark.createDataFrame([*((k, r) for k, r in enumerate(records)), (99, None)], "conv_id bigint, record string")
    got = chat.turns_of_records(df).orderBy("conv_id", "turn").collect()
    for k, (layout, turns) in enumerate(records.values()):
        assert [(r.role, r.text) for r in got if r.conv_id == k] == turns
        assert {r.layout for r in got if r.conv_id == k} == {layout}
    with pytest.raises(ValueError, match="no mapping"):
        chat.turns_of_table(df)


# ---- words ----


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\tabÉé.1", max_size=40)), max_size=6), st.integers(2, 5))
def test_words_and_windows(texts, width):
    whole = vec.SLICE
    names: dict[str, int] = {}
    grams: dict[tuple, int] = {}
    try:
        vec.SLICE = 32
        for lo, hi, buf, at in vec.slices(pa.array(texts, pa.string())):
            w = vec.words(buf, at)
            g, off, _ = vec.windows(w.hash, w.off, width)
            for d in range(hi - lo):
                own = [x for line in (texts[lo + d] or "").split("\n") for x in line.replace("\t", " ").split(" ") if x]
                h = w.hash[w.off[d] : w.off[d + 1]].tolist()
                assert len(h) == len(own)
                for x, y in zip(own, h, strict=True):
                    assert names.setdefault(x, y) == y
                expected = [tuple(own[k : k + width]) for k in range(max(len(own) - width + 1, min(1, len(own))))]
                got = g[off[d] : off[d + 1]].tolist()
                assert len(got) == len(expected)
                for x, y in zip(expected, got, strict=True):
                    assert grams.setdefault(x, y) == y
    finally:
        vec.SLICE = whole
    assert len(set(names.values())) == len(names)
    assert len(set(grams.values())) == len(grams)


def test_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
